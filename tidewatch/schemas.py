"""Explicit schemas as DDL text, all fields nullable. Field names are fixed by the feeds."""

KEYS = ["vendor", "product", "cveId"]


def _ddl(text: str) -> str:
    return " ".join(text.split())


RAW = _ddl("""
    ingestionDate string, ingestionTimestamp string, vendor string, product string,
    cveDataAvailable boolean,
    cvelistv5 array<array<string>>, fkie_nvd array<array<string>>
""")

_LANG_VALUE = "array<struct<lang: string, value: string>>"
_V31 = "array<struct<cvssV3_1: struct<version: string, vectorString: string, baseScore: double>>>"
_PROBLEMS = ("array<struct<descriptions: array<struct<cweId: string, description: string, "
             "lang: string, type: string>>>>")

CNA_DOCUMENT = _ddl(f"""
    cveMetadata struct<datePublished: string, dateReserved: string, dateUpdated: string>,
    containers struct<
      cna: struct<
        datePublic: string,
        descriptions: {_LANG_VALUE},
        impacts: array<struct<capecId: string, descriptions: {_LANG_VALUE}>>,
        metrics: {_V31},
        problemTypes: {_PROBLEMS}>,
      adp: array<struct<problemTypes: {_PROBLEMS}, metrics: {_V31}>>>
""")

NVD_DOCUMENT = _ddl(f"""
    id string, published string, lastModified string, vulnStatus string,
    descriptions {_LANG_VALUE},
    metrics map<string, array<struct<source: string, type: string,
      cvssData: struct<version: string, vectorString: string, baseScore: double>,
      exploitabilityScore: double, impactScore: double>>>,
    weaknesses array<struct<source: string, type: string, description: {_LANG_VALUE}>>
""")

AFFECTED_DOCUMENT = _ddl("""
    cveMetadata struct<cveId: string>,
    containers struct<cna: struct<affected: array<struct<vendor: string, product: string>>>>
""")

CPE_DOCUMENT = _ddl("""
    id string,
    configurations array<struct<nodes: array<struct<cpeMatch: array<struct<criteria: string>>>>>>
""")

SCORE_FIELDS = ["source", "type", "version", "vectorString",
                "baseScore", "impactScore", "exploitabilityScore"]
SCORES = ("array<struct<source: string, type: string, version: string, vectorString: string, "
          "baseScore: double, impactScore: double, exploitabilityScore: double>>")
WEAKNESSES = "array<struct<cweId: string, cweDescription: string>>"
PATTERNS = "array<struct<capecId: string, capecDescription: string>>"

STAGING = _ddl(f"""
    ingestionDate date, vendor string, product string, cveId string,
    cweData {WEAKNESSES}, capecData {PATTERNS}, vulnStatus string, cvssData {SCORES},
    datePublished timestamp, dateReserved timestamp, dateUpdated timestamp,
    datePublic timestamp, lastModified timestamp, Descriptions string,
    ingestionTimestamp timestamp
""")

MASTER = _ddl(f"""
    vendor string, product string, cveId string,
    cweData {WEAKNESSES}, capecData {PATTERNS}, vulnStatus string, cvssData {SCORES},
    datePublished timestamp, dateReserved timestamp, dateUpdated timestamp,
    datePublic timestamp, lastModified timestamp, descriptions string,
    validFrom timestamp, validTo timestamp, currentFlag boolean,
    cvssScore double, cvssVersion string, severity string
""")

STAGING_COLUMNS = [
    "ingestionDate", "vendor", "product", "cveId", "cweData", "capecData", "vulnStatus",
    "cvssData", "datePublished", "dateReserved", "dateUpdated", "datePublic", "lastModified",
    "Descriptions", "ingestionTimestamp",
]
MASTER_COLUMNS = [
    "vendor", "product", "cveId", "cweData", "capecData", "vulnStatus", "cvssData",
    "datePublished", "dateReserved", "dateUpdated", "datePublic", "lastModified", "descriptions",
    "validFrom", "validTo", "currentFlag", "cvssScore", "cvssVersion", "severity",
]
LOOKUP_COLUMNS = [
    "datePublished", "vendor", "product", "cveId", "descriptions", "cvssScore", "severity",
    "vectorString", "impactScore", "exploitabilityScore", "source", "sourceType", "cvssVersion",
    "vulnStatus", "cweData", "capecData", "cvssData", "dateReserved", "dateUpdated",
    "datePublic", "lastModified", "year_published", "date_published",
]

PROFILED = ["vendor", "product", "cveId", "cweData", "capecData", "vulnStatus", "cvssData",
            "datePublished", "dateReserved", "dateUpdated", "datePublic", "lastModified",
            "Descriptions"]

WATERMARK = _ddl("pipeline_name string, last_run_ts timestamp")
BUILD_META = _ddl("collection string, ts timestamp, count bigint")
