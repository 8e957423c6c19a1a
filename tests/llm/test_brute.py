"""The registered queries against plain Python on the smallest tables."""

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import check
import corpus_pipeline
from tidewatch.llm import bpe, decontaminate, queries, simhash, suffixes, toxicity
from tidewatch.llm.queries import TOKENIZERS

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, SF).collect()}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_suffixes(spark, texts):
    got, seen = rows(spark, "op1_suffixes"), set()
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            string = raw[s:s + 100]
            if string in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(string)
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(raw), sum(gone), runs, sha(kept))


def test_suffix_sort_with_hash_collisions(monkeypatch):
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=600)), dtype=np.uint8)
    starts = np.arange(560)
    expected = [bytes(data[s:s + 12]) for s in starts]

    def agree(classes):
        by = defaultdict(set)
        for c, e in zip(classes, expected):
            by[c].add(e)
        return all(len(v) == 1 for v in by.values()), len(by)

    pure, n = agree(suffixes.equal_strings(data, starts, starts * 0, 12))
    assert pure and n == len(set(expected))
    weak = suffixes.Hashes.of
    monkeypatch.setattr(suffixes.Hashes, "of", lambda self, s, n: weak(self, s, n) % np.uint64(5))
    assert agree(suffixes.equal_strings(data, starts, starts * 0, 12))[0]  # verified by bytes


def test_pii_base(spark, texts):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def passes(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            return 16 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    got = rows(spark, "op3_pii")
    for i, text in texts.items():
        spans = {k: [m.span() for m in re.finditer(p, text) if passes(k, m[0])]
                 for k, p in patterns.items()}
        base = ",".join(f"{k}:{a}:{b}" for k, v in spans.items() for a, b in v)
        r = got[i]
        assert [r[f"n_{k}"] for k in patterns] == [len(v) for v in spans.values()]
        assert r.base_sha256 == sha(base.encode())
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_quality_base(spark, texts):
    got = rows(spark, "op4_quality")
    for i, text in texts.items():
        words = WORD.findall(text)
        places = defaultdict(list)
        for k in range(len(words) - 2):
            places[tuple(words[k:k + 3])].append(k)
        inside = {k + j for v in places.values() if len(v) > 1 for k in v for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside), failed)
        assert not (failed and r.kept)


def distance(item, text):
    last = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        last = row
    return min(last)


def test_leaks_with_edits():
    pick = random.Random(3)
    words = "the of onth er ing thand re is wh edsh".split()
    found = 0
    for _ in range(60):
        items = [(i, " ".join(pick.choices(words, k=pick.randint(9, 25)))) for i in range(3)]
        around = " ".join(pick.choices(words, k=20))
        leak = list(pick.choice(items)[1])
        for _ in range(pick.randint(0, len(leak) // 8)):
            at = pick.randrange(len(leak))
            leak[at:at + pick.randint(0, 1)] = pick.choice(["x", "", "a"])
        text = decontaminate.normalise(f"{around} {''.join(leak)} {around}".encode())
        expected = {}
        for i, item in items:
            raw = decontaminate.normalise(item.encode())
            if len(raw) >= decontaminate.MIN_BYTES:
                edits = distance(raw, text)
                if edits <= decontaminate.edits(raw):
                    expected[i] = edits
        got = {r[0]: r[3] for r in decontaminate.search(decontaminate.build_index(items), text)}
        assert got == expected
        found += len(got)
    assert found > 30


def test_leaks_of_whole_items(spark, texts):
    items = {r.item_id: decontaminate.normalise(r.text.encode())
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.op5_decontamination(spark, SF).collect()}
    exact = {(d, i) for d, t in texts.items() for i, b in items.items()
             if b in decontaminate.normalise(t.encode())}
    assert exact <= got


def test_simhash(spark, texts):
    def plain(text):
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
        hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    got, ids = rows(spark, "op8_simhash"), sorted(texts)
    fps = {i: plain(texts[i]) for i in ids}
    assert all(got[i].fingerprint == f"{fps[i]:016x}" for i in ids)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            least = min(root[j] for j in ids if (fps[i] ^ fps[j]).bit_count() <= 3)
            changed |= least != root[i]
            root[i] = least
    assert all(got[i].component_id == root[i] for i in ids)


def test_simhash_dense_group(spark):
    pick = random.Random(5)
    base = pick.getrandbits(64)
    points = {base ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 5))) for _ in range(700)}
    points |= {pick.getrandbits(64) for _ in range(200)}
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)

    def classes(pairs):
        group = {p: p for p in points}

        def top(p):
            while group[p] != p:
                p = group[p]
            return p

        for a, b in pairs:
            group[max(top(a), top(b))] = min(top(a), top(b))
        return {p: top(p) for p in points}

    every = [(a, b) for a in points for b in points if a < b and (a ^ b).bit_count() <= 3]
    found, wanted = classes(edges), classes(every)
    assert len(set(found.values())) == len(set(wanted.values()))
    assert all(found[a] == found[b] for a, b in every)


def test_bpe(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    got = rows(spark, "op10_bpe")
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha(np.array(ids, "<u4").tobytes())
        assert got[i].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False).encode())
    encoder, pick = bpe.Encoder(f"{TOKENIZERS}/byte_bpe_50k.json", bits=4, cache_bytes=400), random.Random(2)
    pieces = ["we're ", "it's", "   ", "\n\n", " the", "é", "中文", " 123", "!!", "\u00a0", "a b", "\U0001f600",
              "<|endoftext|>", "'r", "e", " x" * 9]
    for _ in range(400):
        text = "".join(pick.choices(pieces, k=pick.randint(0, 40)))
        assert encoder.encode(text.encode()).tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.reused_chunks and encoder.encoded_chunks


def test_chat(spark):
    got = {r.conv_id: r for r in queries.op9_chat(spark, SF).collect()}
    said = r"\### Assistant: </turn> ok"
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-7] = [("user", said), ("assistant", said)]
    assert set(got) == set(turns)
    for i, t in turns.items():
        learned = "".join(x for role, x in t if role == "assistant")
        assert got[i].n_turns == len(t) and got[i].loss_chars == len(learned)
        assert got[i].turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in t).encode())
        assert got[i].loss_sha256 == sha(learned.encode())


def test_chat_parts(spark):
    from tidewatch.llm import chat
    schema = f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    part = lambda kind, text=None, ref=None, tokens=None: (kind, text, ref, tokens)
    df = spark.createDataFrame([
        (1, 0, "user", [part("text", "see <"), part("image", ref="a.png"), part("document", ref="b.pdf", tokens=7)]),
        (1, 1, "assistant", [part("text", "yes"), part("audio", ref="c.wav"), part("text", "no")])], schema)
    r = chat.format_conversations(df).first()
    assert r.formatted == ("### user: see \\l<image:1><document:2></turn>\n"
                           "### assistant: yes<audio:3>no</turn>\n")
    assert [r.formatted[m.start:m.end] for m in r.mask] == ["yes", "no"]
    assert [(a.type, a.ref, a.tokens) for a in r.attachments] == [
        ("image", "a.png", 256), ("document", "b.pdf", 7), ("audio", "c.wav", 128)]
    assert r.attachment_tokens == 391


def test_urls(spark):
    assert check.compare(check.connect(SF), queries.op6_urls(spark, SF), queries.URLS_SQL) == ""


def test_toxicity_held_out():
    pick = random.Random(4)
    syllables = "an er th on re in ti st es ou".split()
    stem = ["idio", "morroz", "chlla"]

    def text(bad):
        words = ["".join(pick.choices(syllables, k=pick.randint(1, 4))) for _ in range(pick.randint(20, 200))]
        for _ in range(4 * bad):
            words[pick.randrange(len(words))] = pick.choice(stem) + pick.choice(["t", "n", "ts", "gu", "ri"])
        return " ".join(words).encode()

    def bags(sample):
        data = np.frombuffer(b"".join(sample), dtype=np.uint8)
        bucket, passage, ends = toxicity.ngrams(data, np.append(0, np.cumsum([len(s) for s in sample])))
        return [bucket[passage == p] for p in range(ends[-1])], np.searchsorted(ends, np.arange(ends[-1]), side="right")

    labels = np.array([i % 2 for i in range(700)])
    sample = [text(b) for b in labels]
    found, owner = bags(sample)
    model = toxicity.fit(owner, labels[owner], found)
    offsets = lambda s: np.append(0, np.cumsum([len(x) for x in s]))
    join = lambda s: np.frombuffer(b"".join(s), dtype=np.uint8)
    model = toxicity.calibrated(model, model.logits(join(sample), offsets(sample)), labels)
    fresh = [text(b) for b in labels]
    right = (model.score(model.logits(join(fresh), offsets(fresh))) >= 0.5) == labels
    assert right.mean() > 0.9


def test_secrets(spark):
    got = queries.op2_secrets(spark, SF.replace("0.001", "0.01")).collect()
    plain = [r for r in got if re.fullmatch("[a-zA-Z]+", r.candidate)]
    keys = [r for r in got if re.fullmatch("[0-9a-f]{40}", r.candidate)]
    assert all(r.secret for r in keys) and not any(r.secret for r in plain)


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    judged = {r.doc_id: r for r in queries.op4_quality(spark, SF).collect()}
    ids = [r.doc_id for r in got]
    assert ids and len(ids) == len(set(ids)) and all(judged[i].kept for i in ids)
    hit = {r.doc_id for r in queries.op5_decontamination(spark, SF).collect()}
    assert not hit & set(ids)
    kept = spark.read.parquet(f"{SF}/documents.parquet").where(
        F.col("doc_id").isin([i for i, r in judged.items() if r.kept]))
    first = {r.doc_id for r in simhash.near_duplicates(kept).collect() if r.doc_id == r.component_id}
    assert set(ids) == first - hit
