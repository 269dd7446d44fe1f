"""Cases that earlier versions of the operators lost."""

import base64
import struct

import pytest


@pytest.fixture
def few_partitions(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_crowded_rows_meet_over_first_rows_that_are_not_crowded(spark, few_partitions):
    """60 alike rows share 14 n-grams. Each task's first rows of these n-grams are longer rows with
    7 of them (too few to be crowded with the limit of 16 rows) and 10 n-grams that a copy has, too."""
    from rarefy.llm.graph import components
    from rarefy.llm.jaccard import _blocking
    gram = lambda *k: struct.pack(f"<{len(k)}Q", *(x << 40 for x in sorted(k)))
    rows = []
    for k in range(400):
        pair = 1000 + 10 * (k // 2)
        rows.append((k, 200, gram(*range(1 + k % 4 // 2 * 7, 8 + k % 4 // 2 * 7), *range(pair, pair + 10))))
    rows += [(10_000 + k, 50, gram(*range(1, 15))) for k in range(60)]
    nodes = spark.createDataFrame(rows, "node long, size long, keys binary")
    links = _blocking(nodes, 80, 100, 1, 1_000_000)
    root = {r["node"]: r["root"] for r in components(links).collect()}
    assert len({root.get(10_000 + k, -k - 1) for k in range(60)}) == 1


def test_rows_that_share_too_few_ngrams_are_not_paired(spark, few_partitions, monkeypatch):
    """100 rows share one n-gram or two with others each, which is no link at their size; two linked rows stay."""
    from rarefy.llm import jaccard
    gram = lambda k: struct.pack(f"<{len(k)}Q", *(x << 40 for x in sorted(k)))
    rows = [(k, 100, gram({*range(1000 * k + 10, 1000 * k + 35), k // 2 + 1, (k + 1) // 2 + 1})) for k in range(100)]
    rows += [(200, 100, gram([*range(900_000, 900_027)])), (201, 100, gram([*range(900_001, 900_028)]))]
    nodes = spark.createDataFrame(rows, "node long, size long, keys binary")
    tallies, seen = jaccard._tallies, []
    monkeypatch.setattr(jaccard, "_tallies", lambda *a, **k: seen.append(tallies(*a, **k)) or seen[-1])
    links = jaccard._blocking(nodes, 80, 100, 4, 1_000_000)
    assert {tuple(sorted(r)) for r in links.collect()} == {(200, 201)}
    assert {tuple(sorted(r)) for r in seen[0].where("NOT hot").select("a", "b").collect()} == {(200, 201)}


@pytest.mark.parametrize("buckets", [1, 3])
def test_shared_ngrams_are_counted_over_tasks(spark, few_partitions, buckets):
    """N-grams that a task has once, or more often, and that other tasks have, too."""
    from rarefy.llm.jaccard import _supported
    rows = [(k, [x for x in range(1, 60) if (k * 7919 + x * x * 31) % 11 < 2 + k % 3] + [10_000 + k]) for k in range(40)]
    df = {}
    for _, g in rows:
        for x in g:
            df[x] = df.get(x, 0) + 1
    held = [(k, struct.pack(f"<{len(g)}Q", *((x << 40) + x * 0x9E3779B1 % (1 << 32) for x in g))) for k, g in rows]
    for parts in (1, 7, 40):
        nodes = spark.createDataFrame(spark.sparkContext.parallelize(held, parts), "node long, keys binary")
        found = {r["node"]: r["n"] for r in _supported(nodes, buckets, 1_000_000).collect()}
        assert found == {k: n for k, g in rows if (n := sum(df[x] > 1 for x in g))}


def test_bpe_tasks_of_equal_rows(spark):
    """Tasks that hold the same rows, and tasks whose texts are equal only when put together."""
    import public_tokenizers as P
    import tiktoken
    from rarefy.llm import bpe
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "one passage of several words, each of them different from all others"
    for parts in ([[(1, text)]] * 2, [[(1, text), (2, None), (3, "a b c")]] * 3, [[(1, "ab cd"), (2, "ef gh")], [(1, "ab c"), (2, "def gh")]]):
        docs = spark.createDataFrame(spark.sparkContext.parallelize([p for p in parts], len(parts)).flatMap(lambda p: p), "doc_id long, text string")
        out = bpe.decode(bpe.encode(docs, ranks, P.PATTERN, buckets=5), ranks).collect()
        want = [(i, enc.encode_ordinary(t or ""), (t or "").encode()) for p in parts for i, t in p]
        assert sorted((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in out) == sorted(want)


def test_pii_bare_at_and_long_local_parts():
    from rarefy.llm import pii
    for before, address, after in (("write to ", "jane.doe at example.com", "."), ("", "jane_x at mail.example.co.uk", " now"), ("mail ", "jane at example.org", ""),
                                   ("contact: ", "bob at example.com", ""), ("see ", "jane dot doe at example.com", ""), ("x ", "a.b.c.d.e [at] x [dot] y", ""),
                                   ("or ", "a dot b dot c dot d dot e dot f at x dot com", "")):
        base, found = pii.spans(before + address + after)
        assert not base and found == [("email", len(before), len(before + address))]
    for text in ("meet at example.com", "contact us at example.com", "in 2019 at example.com", "v1.2 ran at node.js", "He left.At noon.It rained", "see me.They at noon.It"):
        assert pii.spans(text)[1] == []


def test_pipeline_dedup_of_rows_that_share_an_id(spark):
    """A copy goes alone, not with the other texts of its doc_id; a repeated row elsewhere changes nothing."""
    import corpus_pipeline
    words = [f"w{k}" for k in range(60)]
    own, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(1, "Copy of a text"), (2, "copy OF a text"), (1, "unique"), (1, ""), (3, "Twice"), (3, "tWice"), (3, None), (None, "x"), (None, "x")]
    docs = lambda x: spark.createDataFrame(x, "doc_id long, text string")
    left = [(r["doc_id"], (r["text"] or "").lower()) for r in corpus_pipeline.exact_dedup(spark, docs(rows), "").collect()]
    assert sorted(left, key=repr) == sorted([(2, "copy of a text"), (1, "unique"), (3, "twice"), (3, ""), (None, "x"), (None, "x")], key=repr)
    rows = [(4, own), (5, near), (5, "a text that stands on its own with words of no other document"), (6, "short")]
    left = corpus_pipeline.near_dedup(spark, docs(rows), "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == sorted(r for r in rows if r[1] != near)


def test_repeated_rows_cost_as_much_as_copies(spark):
    """Rows that repeat a document are read and indexed once: the runs are those of copies under other ids."""
    from pyspark.sql import functions as F
    from rarefy.llm import fm_dedup, suffix_dedup
    from rarefy.llm.anchors import Symbols, repeated_windows
    text = " ".join(f"word{k}" for k in range(120))
    for symbols, index in ((Symbols(True, 50, 8), fm_dedup.index(50)), (Symbols(False, 400, 40), suffix_dedup.index(400, 50))):
        found = []
        for ids in (range(200), [7] * 200):
            docs = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string").repartition(5)
            d = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
            runs = repeated_windows(d, symbols, index)
            found.append((runs.count(), {r["n"] for r in runs.collect()}))
        assert found[0] == found[1] and found[0][1] == {200}
    out = suffix_dedup.repeated_bytes(spark.createDataFrame([(7, text)] * 300, "doc_id long, text string"))
    assert {(r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in out.collect()} == {(len(text), len(text), b"")}
    out = fm_dedup.earlier_words(spark.createDataFrame([(7, text)] * 300 + [(8, text)], "doc_id long, text string"))
    assert {(r["doc_id"], r["n_removed"]) for r in out.collect()} == {(7, 0), (8, 120)}


def test_bpe_of_rows_whose_order_in_a_task_differs_per_read(spark):
    import public_tokenizers as P
    import tiktoken
    from pyspark.sql import functions as F
    from rarefy.llm import bpe
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(i, f"text number {i} with words of its own: w{i * 7} x{i * 13}") for i in range(300)] + [(1, None), (None, "no id"), (2, "")]

    def shuffled(batches):
        import random
        import pyarrow as pa
        for b in batches:
            order = list(range(b.num_rows))
            random.shuffle(order)
            yield b.take(pa.array(order))

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, F.col("text")).mapInArrow(shuffled, "doc_id long, text string")
    out = bpe.decode(bpe.encode(docs, ranks, P.PATTERN, block_chars=700, buckets=5), ranks).collect()
    want = [(i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in out), key=repr) == sorted(want, key=repr)


def test_benchmark_items_without_an_id_count(spark):
    from rarefy.llm import decontaminate
    passage = "a passage of the benchmark that is long enough to be told from any other text, with some words more"
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "clean text"), (None, passage), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, passage), (5, None), (None, "")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, items).collect()) == [2, 3]
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()} == {(1, None), (None, None)}


def test_pipeline_stages_with_clashing_columns_nulls_and_empty_tables(spark):
    import corpus_pipeline
    schema = "doc_id long, text string, lang string, _score double, lang_pred string, score double, _digest string, digest string, gone long, gone_row long, _gone_text string, row long"
    text = "several words of plain English text that the profile of the language can be told from, and some more of them"
    rows = [(1, text, "en", *[None] * 9), (2, text, "en", *[None] * 9), (3, None, None, *[None] * 9), (None, "other words that stand in no other text", "en", *[None] * 9), (2, text, "en", *[None] * 9)]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:3]:
            out = stage(spark, table, "")
            assert out.columns == docs.columns, name
            kept = {r["doc_id"] for r in out.collect()}
            assert kept == ({1, 2, None} if name == "language ID" else {2, 3, None} if name == "exact dedup" else {1, 3, None}) if table is docs else not kept


def test_a_stray_time_leaves_the_slots_even(spark):
    from rarefy.llm import warc
    rows = [(i, "http://a/", 1_700_000_000 + i, "response" if i % 2 else "revisit", "x", None, None) for i in range(1000)] + [(5000, "http://a/", 0, "response", "x", None, None), (5001, "http://a/", None, "revisit", "x", None, None)]
    records = spark.createDataFrame(rows, "record_id long, url string, at long, kind string, etag string, last_modified string, headers map<string,string>")
    sizes = [r["count"] for r in warc.with_slots(records, 64).groupBy("slot").count().collect()]
    assert len(sizes) >= 60 and max(sizes) <= 40
    got = {r["record_id"]: (r["target_id"], r["status"]) for r in warc.resolve_revisits(records, 64).collect()}
    assert got[0] == (5000, "resolved") and got[5001] == (None, "no_target")
    assert all(got[i] == (i - 1, "resolved") for i in range(2, 1000, 2))
    assert warc.resolve_revisits(records.limit(0)).count() == 0


def test_languages_are_counted_before_they_are_collected(spark):
    from rarefy.llm import langid
    many = spark.createDataFrame([(f"some words of language {k}", f"l{k}") for k in range(600)], "text string, lang string")
    with pytest.raises(ValueError, match="512 languages"):
        langid.train(many)
    names, vectors = langid.train(many.where("lang < 'l2'"))
    assert names == sorted({f"l{k}" for k in range(600) if f"l{k}" < "l2"}) and vectors.shape == (len(names), langid.DIMENSION)
    assert langid.train(many.limit(0))[0] == []
