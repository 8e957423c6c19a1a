"""A labelled table of findings, from which the forest of the secret scan is trained.

Lines are made from templates by hashes of their numbers, in the JVM: what people write around
credentials, and what looks like it. A line's label follows from what its template means, not from the
form of the value: a random key is a secret where a program would use it, and none where it is a
commit, a checksum, an identifier or a fixture of a test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import secrets

#: Lines of the table; a fifth of them is held out.
LINES = 12_000
#: Stands in no option.
BETWEEN = "\x1f"

WORDS = """account address after again answer apple around battery because before better between bridge
button castle change chapter children circle closed column common correct country course create
current daily danger default delete design detail develop direct doctor dragon during early earth
editor eleven engine enough entry error event every example family father figure filter final first
flower follow forest friend garden general global ground group handle happy header horse house image
index inside island journal kitchen label language large later leader letter light limit listen little
local logger machine manager market member memory message method middle minute model monkey morning
mother mountain notice number object offer office option orange order other output parent partner
pattern people person picture planet player please point policy power present press private process
product profile public question random reader reason record region release remote report request
result return river school screen second section select server service session settings should silver
simple single sister smooth source spring square stable staple station status storage street string
student summer sunshine support system table teacher thread ticket today together tomorrow travel
under update upload value version village visitor water weather window winter wonder yellow""".split()
CONFIG = ["deploy/.env", "config/settings.yaml", "app/config.json", "etc/service.conf", "infra/prod.properties",
          "src/db/connect.ini", "ops/values.yml"]
PLAIN = ["src/main/app.py", "notes", "src7", "web/index.html", "lib/client.js", "page", "", "mail/inbox/42"]
TESTS = ["tests/fixtures/keys.json", "examples/demo.py", "spec/mock_auth.yaml", "docs/sample.env", "src/test/login.js"]
LOGS = ["var/log/app.log", "CHANGELOG.md", "package-lock.json", "Cargo.lock", "build/output.log", "src11", "news"]
NAMES = ["password", "db_password", "passwd", "secret", "client_secret", "api_key", "auth_token", "token",
         "access_key", "private_key", "credentials"]


def _hash(salt: str) -> Column:
    return F.xxhash64(F.col("id"), F.lit(salt))


def _pick(options: list[str], salt: str) -> Column:
    place = F.pmod(_hash(salt), F.lit(len(options))).cast("int")
    # one literal, not one per option: the templates pick a thousand times
    return F.get(F.split(F.lit(BETWEEN.join(options)), BETWEEN), place)


def _digest(salt: str) -> Column:
    return F.sha2(F.concat(F.col("id").cast("string"), F.lit(salt)).cast("binary"), 512)


def _hex(n: int, salt: str = "hex") -> Column:
    return F.substring(_digest(salt), 1, n)


def _mixed(n: int, salt: str = "mixed") -> Column:
    return F.substring(F.base64(F.unhex(_digest(salt))), 3, n)


def _alnum(n: int, salt: str = "alnum") -> Column:
    return F.substring(F.regexp_replace(F.base64(F.unhex(_digest(salt))), "[^A-Za-z0-9]", ""), 1, n)


def _words(n: int, salt: str, between: str = "") -> Column:
    return F.concat_ws(between, *[_pick(WORDS, f"{salt}{i}") for i in range(n)])


def _digits(n: int, salt: str = "digits") -> Column:
    return F.substring(F.translate(_digest(salt), "abcdef", "123456"), 1, n)


def _templates() -> list[tuple[Column, Column | None, list[str]]]:
    """(text, its secret or None, paths)"""
    name, sign = _pick(NAMES, "name"), _pick([" = ", ": ", "=", " := "], "sign")
    # two lines of five have nothing before, or behind
    some = lambda salt: F.when(F.pmod(_hash(f"no {salt}"), F.lit(5)) < 2, "").otherwise(_words(2, salt, " "))
    lead, tail = some("lead"), some("tail")
    quoted = lambda v: F.concat(F.lit('"'), v, F.lit('"'))
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    anywhere, used = CONFIG + PLAIN, CONFIG * 2 + PLAIN
    weak = F.concat(F.initcap(_pick(WORDS, "weak")), _digits(4, "year"))
    odd = F.concat(F.translate(_pick(WORDS, "odd"), "aeios", "@3!0$"), _digits(2, "odd"), F.lit("!"))
    given = _pick(["changeme", "letmein", "hunter2", "qwerty", "admin123", "welcome1", "iloveyou", "dragon99"], "given")
    phrase, key_id = _words(3, "phrase"), F.concat(F.lit("AKIA"), F.upper(_alnum(16, "id")))
    uuid = F.concat_ws("-", _hex(8, "u"), _hex(4, "v"), _hex(4, "w"), _hex(4, "x"), _hex(12, "y"))
    secrets_ = [(v, used) for v in (_hex(40), _hex(32), _hex(64), _mixed(40), _mixed(24), _alnum(20), key_id)]
    secrets_ += [(v, anywhere) for v in (weak, odd, given, phrase, F.concat(F.lit("sk-live-"), _alnum(24)))]
    found = []
    for i, (value, paths) in enumerate(secrets_):
        said = quoted(value) if i % 2 else value
        found += [(line(lead, "\n", name, sign, said, "\n", tail), value, paths),
                  (line(lead, " ", name, sign, quoted(value), " ", tail), value, paths)]
        # the same forms where nobody uses them
        found.append((line(name, sign, quoted(value), "\n", tail), None, TESTS))
    found += [(line(lead, " ", key_id, " ", tail), key_id, anywhere),
              (line("Authorization: Bearer ", _alnum(32, "bearer"), " ", tail), _alnum(32, "bearer"), anywhere),
              (line("X7 qq ", _mixed(40, "bare"), " zz ", _hex(3)), _mixed(40, "bare"), CONFIG)]
    harmless = [
        line(lead, " ", uuid, " ", tail), line("request id ", uuid, " ", tail), line("key: ", uuid, "\n", tail),
        line("commit ", _hex(40, "c"), " by ", tail), line("merge ", _hex(40, "m"), " into ", tail),
        line(lead, " ", _hex(40, "p"), " ", tail), line('"integrity": "sha512-', _mixed(60, "i"), '",'),
        line("checksum = ", quoted(_hex(64, "s"))), line("sha256:", _hex(64, "t"), " ", tail),
        line(lead, " /2024/05/", _words(4, "slug", "-"), " ", tail), line(lead, " ", _words(4, "long"), " ", tail),
        line(lead, " ", _words(3, "caps"), ", ", tail), line("see ", _words(3, "path", "/"), "/", _words(2, "file", "_"), ".html"),
        line("key: ", _words(2, "ident", "_")), line("api_key: settings.", F.upper(_words(2, "upper", "_"))),
        line("token = get_token(", _pick(WORDS, "arg"), ")"), line("password = os.environ[", quoted(F.lit("DB_PASSWORD")), "]"),
        line("password: <your-password> ", tail), line("secret = ${", F.upper(_pick(WORDS, "var")), "_SECRET}"),
        line("password = ", quoted(F.lit("********")), " ", tail), line("api_key = xxxxxxxxxxxxxxxx ", tail),
        line("primary key: ", _words(2, "pk", "_"), ", ", tail), line(lead, " ", _digits(16), " ", tail),
        line(lead, " ", _digits(20, "d20"), ". ", tail), line("order no. ", _digits(8, "o"), "-", _digits(10, "r"), " ", tail),
        line("access: ", _pick(["public", "private", "read-only", "internal"], "access"), " ", tail),
        line("the key = ", _words(2, "said", "-"), " ", tail), line("author: ", _words(2, "name", " "), "\n", tail)]
    found += [(text, None, anywhere + LOGS) for text in harmless for _ in range(2)]
    # a form says what a password is, a configuration has one
    kind = _pick(["required", "null", "None", "true", "false", "string", "optional"], "kind")
    found.append((line("password: ", kind, "\n", tail), None, TESTS + PLAIN))
    found += [(line(name, sign, given, "\n", tail), given, CONFIG)] * 3
    return found


def lines(spark: SparkSession, count: int = LINES) -> DataFrame:
    """(doc_id, path, text, secret): ``secret`` is the value in the line that is one, or null."""
    made = _templates()
    which = F.pmod(_hash("template"), F.lit(len(made)))
    row = None
    for i, (text, secret, paths) in enumerate(made):
        secret = F.lit(None).cast("string") if secret is None else secret
        line = F.struct(text.alias("text"), secret.alias("secret"), _pick(paths, "path").alias("path"))
        row = F.when(which == i, line) if row is None else row.when(which == i, line)
    return (spark.range(count).select(F.col("id").alias("doc_id"), row.alias("row"))
            .select("doc_id", "row.path", "row.text", "row.secret"))


def labelled(spark: SparkSession, pieces: DataFrame, count: int = LINES) -> DataFrame:
    """Findings in the lines with ``secrets.FEATURES``, ``label`` and ``held_out``.

    ``pieces`` is the dictionary; the words of the lines are known as well, as those of a corpus are.
    """
    # written: the findings and the labels name a line's text many times, and it is a long expression
    table = cut_lineage(lines(spark, count), "lines")
    own = F.array(*[F.lit(p) for p in sorted({w[:secrets.PIECE] for w in WORDS})])
    known = pieces.union(spark.range(1).select(F.explode(own).alias("piece"))).distinct()
    found = secrets.features(secrets.findings(table), known)
    secret = table.select("doc_id", "secret")
    return (found.join(secret, "doc_id")
            .withColumn("label", F.coalesce(F.contains("secret", "candidate") & (F.length("candidate") * 2 > F.length("secret")),
                                            F.lit(False)).cast("int"))
            .withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
            .drop("secret"))
