"""The pipeline on sf0.001 against a plain version of each stage."""

import re

import duckdb

D = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as P
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{D}/documents.parquet'").fetchall()
    text = dict(docs)
    frame, seen = spark.read.parquet(f"{D}/documents.parquet"), []
    for name, stage in P.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, D).toPandas(), frame.schema)
        seen.append({r["doc_id"] for r in frame.select("doc_id").collect()})
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    told, exact, near, clean = seen
    assert all(re.search(r"[^\W\d_]", text[i] or "") for i in told) and len(told) >= 0.98 * len(docs)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keep = {}
    for i in sorted(told):
        keep[text[i].translate(low)] = i
    assert exact == set(keep.values())
    sets = {}
    for i in exact:
        w = re.findall(r"[^\x20\x09-\x0D]+", text[i].translate(low))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in exact}
    for _ in exact:
        change = {b for a in exact for b in exact if a < b and root[a] < root[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
        if not change:
            break
        for a in exact:
            for b in exact:
                if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert near == {i for i in exact if root[i] == i}
    plain = lambda t: re.sub(r"[\W_]+", " ", t.lower())
    items = [plain(t) for (t,) in duckdb.sql(f"SELECT text FROM '{D}/benchmark.parquet'").fetchall()]
    assert clean <= near and not any(t in plain(text[i]) for i in clean for t in items)
    last = P.STAGES[-1][1](spark, frame, D)
    assert last.where("NOT round_trip").count() == 0 and {r["doc_id"] for r in last.select("doc_id").collect()} == clean
