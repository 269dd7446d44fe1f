"""Operators against brute force on small tables, with nulls, empty and repeated rows, clashing columns."""

import base64
import hashlib
import random
import re
from collections import Counter

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, row long, size long, node long, _text string"


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéßT1.") for _ in range(r.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, out = text(90), []
    for i in range(60):
        t = text(r.randint(1, 120))
        if i % 5 == 0:
            t = f"{t} {passage}\n{text(3)}"
        if i % 7 == 3 and out:
            t = out[-1][1]
        if i % 7 == 5 and out:
            w = (out[-1][1] or "x").split(" ")
            w[len(w) // 2] = "changed"
            t = " ".join(w)
        out.append((i, t))
    long = text(9000)
    out += [(60, None), (61, ""), (62, " \n\t"), (63, "a"), (64, long), (65, long + " end"), (66, "ABC def"), (67, "abc DEF"), (68, "12 34"), (None, passage),
            (70, passage), (70, passage), (71, (passage + " ") * 3)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 2, 3, "x") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_suffix_dedup(docs, rows, none):
    from rarefy.llm.suffix_dedup import repeated_bytes
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + 400] for _, b in raw for k in range(len(b) - 399))
    want = []
    for i, b in raw:
        mark = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k:k + 400]] > 1:
                mark[k:k + 400] = b"\1" * 400
        want.append((i, len(b), sum(mark), sum(m and (k == 0 or not mark[k - 1]) for k, m in enumerate(mark)), bytes(c for c, m in zip(b, mark) if not m)))
    out = repeated_bytes(docs)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 1000
    assert repeated_bytes(none).count() == 0


def test_substring_dedup(docs, rows, none):
    from rarefy.llm.fm_dedup import earlier_words
    order = lambda i: 1 << 63 if i is None else i
    first = {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        w = WORD.findall(t or "")
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), order(i))
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {k + j for k in range(len(w) - 49) if first[tuple(w[k:k + 50])] < order(i) for j in range(50)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone).encode()))
    assert got(earlier_words(docs), "doc_id", "n_words", "n_removed", "kept") == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 500
    assert earlier_words(none).count() == 0


def test_large_groups_are_cut_to_windows(docs):
    """The way for groups that are too large for one task gives the same runs."""
    from pyspark.sql import functions as F
    from rarefy.llm import fm_dedup
    from rarefy.llm.anchors import Symbols, repeated_windows
    d = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    marks = []
    for most in (2000, 1):
        runs = repeated_windows(d, Symbols(True, 50, 8), fm_dedup.index(50), max_group=most).distinct().collect()
        marks.append({(r["row"], r["start"] + k, r["n"], r["first_id"]) for r in runs for k in range(r["windows"])})
    assert marks[0] == marks[1] and marks[0]


def test_byte_bpe(docs, rows, none):
    import public_tokenizers as P
    import tiktoken
    from rarefy.llm import bpe
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = bpe.decode(bpe.encode(docs, bpe.read_ranks(path), P.PATTERN, block_chars=2000), ranks)
    want = sorted(((i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=repr)
    assert got(out, "doc_id", "ids", "decoded") == want
    assert bpe.encode(none, ranks, P.PATTERN).count() == 0


def test_exact_dedup(docs, rows, none):
    from rarefy.llm.exact import exact_duplicates
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(low), []).append(i)
    want = [(i, max((x for x in g if x is not None), default=None), len(g), sha(t)) for t, g in groups.items() for i in g]
    for block in (1024, 7):
        out = exact_duplicates(docs, block_bytes=block)
        assert got(out, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=repr)
        assert out.where("kept").count() == len(groups)
    assert exact_duplicates(none).count() == 0


@pytest.mark.parametrize("n,num", [(3, 90), (5, 80), (2, 50)])
def test_jaccard_join(docs, rows, none, n, num):
    from rarefy.llm.jaccard import jaccard_join
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append((i, {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()))
    link = [[bool(a) and bool(b) and 100 * len(a & b) >= num * len(a | b) for _, b in sets] for _, a in sets]
    want = []
    for k, (i, s) in enumerate(sets):
        reach, front = {k}, [k]
        while front:
            front = [m for m in range(len(sets)) if m not in reach and any(link[f][m] for f in front)]
            reach |= set(front)
        ids = [sets[m][0] for m in reach if sets[m][0] is not None]
        want.append((i, len(s), min(ids, default=None), sum(link[k][m] for m in range(len(sets)) if m != k)))
    for options in ({}, {"cold": 2, "block_rows": 3, "sample_rows": 10}, {"cold": 3, "bucket_grams": 500}):
        assert got(jaccard_join(docs, n, num, 100, **options), "doc_id", "n_shingles", "component_id", "n_links") == sorted(want, key=repr)
    assert jaccard_join(none, n, num, 100).count() == 0


def test_decontamination(spark, docs, rows, none):
    from rarefy.llm.decontaminate import clean, contaminated
    item = [t for i, t in rows if i == 70][0]
    other = "completely different words that no document of this table has anywhere in it at all"
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, ""), (5, "!!")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    assert {(i, 1) for i, t in rows if t and item in t} <= found
    assert not any(i == 2 or i > 2 for _, i in found)
    assert clean(docs, bench).columns == docs.columns
    assert clean(docs, bench).count() == len(rows) - sum(1 for i, t in rows if (i, 1) in found)
    assert contaminated(none, bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0
    typo = item[:60] + "#" + item[62:100].replace("a", "b", 1) + item[100:]
    more = spark.createDataFrame([(9, typo)], "doc_id long, text string")
    assert contaminated(more, bench).count() > 0


def test_pii_base_patterns_and_disguises(spark, docs, none):
    from rarefy.llm import pii
    r = random.Random(1)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(5000):
        t = "".join(r.choice("ab@@..1_2-é 3+") for _ in range(r.randint(0, 30)))
        assert pii.emails(t) == [m.span() for m in email.finditer(t)]
        assert pii.ips(t) == [m.span() for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    cases = {"bob (at) example (dot) com": "email", "ann at site dot org": "email", "аnn@еxample.com": "email",
             "plus one five five five one two three four five six seven": "phone"}
    for t, kind in cases.items():
        base, found = pii.spans("see " + t + " now")
        assert not base and found == [(kind, 4, 4 + len(t))]
    assert pii.spans("one of the two at the dot")[1] == []
    assert pii.find_pii(docs).count() == docs.count() and pii.find_pii(none).count() == 0


def test_language_id(spark, docs, none):
    from rarefy.llm import langid
    r = random.Random(2)
    make = lambda letters: " ".join("".join(r.choice(letters) for _ in range(5)) for _ in range(60))
    train = spark.createDataFrame([(i, make("abcde"), "x") for i in range(20)] + [(i, make("vwxyz"), "y") for i in range(20)] + [(99, None, None)],
                                  "doc_id long, text string, lang string")
    model = langid.train(train)
    test = spark.createDataFrame([(1, make("abcde")), (2, make("vwxyz")), (3, None), (4, "12 !"), (5, "a")], "doc_id long, text string")
    out = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in langid.predict(test, model).collect()}
    assert out[1][0] == "x" and out[2][0] == "y" and out[3] == out[4] == ("und", 0.0) and out[5][0] in "xy"
    assert all(0 <= s <= 1 for _, s in out.values())
    assert langid.predict(none, model).count() == 0
    assert {x["lang_pred"] for x in langid.predict(docs, langid.train(none)).collect()} == {"und"}


def test_quality(spark, docs, none):
    from rarefy.llm import quality
    r = random.Random(3)
    good, bad = "plain quiet words of prose", "BUY!! now### cheap$$$ %%%"
    rows = [(i, " ".join(r.choice((good if i % 2 else bad).split()) for _ in range(20))) for i in range(200)]
    d = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] + [(3, None), (None, 1)], "doc_id long, quality int")
    w = quality.train(d, labels)
    out = {x["doc_id"]: x["score"] for x in quality.score(d, w).collect()}
    assert all((out[i] >= 0.3) == (i % 2 == 1) for i in range(150, 200)) and out[900] == out[901]
    assert quality.score(none, w).count() == 0
    assert {x["score"] for x in quality.score(docs, quality.train(d, labels.limit(0))).collect()} == {0.5}


def test_warc(spark):
    from rarefy.llm import warc
    r = random.Random(4)
    urls = ["http://www.A.example/x/?b=2&utm_source=q&a=1#top", "https://a.example:443/x?a=1&b=2", "http://b.example/", "http://b.example", None]
    rows = []
    for i in range(300):
        kind = r.choice(["response", "revisit", "other"])
        rows.append((i, r.choice(urls), r.choice([None, *range(40)]), kind, r.choice(['"t"', 'W/"t"', '"u"', None]), r.choice(["m", "n", None]),
                     r.choice([None, {"ETag": str(i), "Content-Length": "5", "X": str(i)}])))
    schema = "record_id long, url string, at long, kind string, etag string, last_modified string, headers map<string,string>"
    site = {urls[0]: "a.example/x?a=1&b=2", urls[1]: "a.example/x?a=1&b=2", urls[2]: "b.example", urls[3]: "b.example", None: None}
    want = []
    for i, u, at, kind, tag, mod, head in rows:
        if kind != "revisit":
            continue
        full = [x for x in rows if x[3] == "response" and u and x[1] and x[2] is not None and at is not None and site[x[1]] == site[u] and x[2] < at]
        t = max(full, key=lambda x: (x[2], x[0])) if full else None
        bare = lambda x: x and x.removeprefix("W/")
        status = "no_target" if t is None else "resolved" if tag and bare(t[4]) == bare(tag) else "mismatch" if tag else \
            "resolved" if mod and t[5] == mod else "mismatch" if mod else "unvalidated"
        merged = None
        if status == "resolved":
            merged = {k.lower(): v for k, v in (t[6] or {}).items()}
            merged |= {k.lower(): v for k, v in (head or {}).items() if k.lower() not in warc.NOT_MERGED}
        want.append((i, site[u], t and t[0], status, merged and dict(sorted(merged.items()))))
    for slots in (512, 3):
        out = warc.resolve_revisits(spark.createDataFrame(rows, schema), slots)
        found = [(x["record_id"], x["canonical_url"], x["target_id"], x["status"], x["headers"] and dict(sorted(x["headers"].items()))) for x in out.collect()]
        fix = lambda v: [(a, b, c, d, e or None) for a, b, c, d, e in sorted(v)]
        assert fix(found) == fix(want)
    assert warc.resolve_revisits(spark.createDataFrame([], schema)).count() == 0
