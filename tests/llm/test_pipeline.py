"""The pipeline over the smallest tables: what each stage keeps, against plain Python on that stage's own input."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa

import corpus_pipeline as cp
from cohortcast.llm import jaccard, langid, tokens
from cohortcast.llm.common import table, written

from test_operators import SF, _strings, shingles


def keep_one_of_each_class(rows):
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    class_of = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((class_of[a], class_of[b]))
                class_of = {i: x if c == y else c for i, c in class_of.items()}
    return sorted(i for i, c in class_of.items() if i == c)


def keep_clean(rows, items):
    low = lambda t: {tuple(s) for s in _strings(t)}
    items = [s for s in map(low, items) if s]
    return sorted(r["doc_id"] for r in rows
                  if not any(4 * len(s & low(r["text"])) >= 3 * len(s) for s in items))


def test_stages_keep_what_plain_rules_keep(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, []
    for name, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept.append(docs.collect())
    ids = [sorted(r["doc_id"] for r in rows) for rows in kept]
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_copies", "decontamination", "personal_data", "packing"]
    assert set(ids[0]) <= {r["doc_id"] for r in table(spark, SF, "documents").select("doc_id").collect()}
    assert ids[1] == keep_one_of_each_class(kept[0])
    assert ids[2] == keep_clean(kept[1], [r["text"] for r in table(spark, SF, "benchmark").collect()])
    assert ids[3] == ids[2]
    places = cp.run(spark, SF).collect()
    assert sorted({r["doc_id"] for r in places}) == ids[3]
    at = {}
    for r in sorted(places, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 2048


def test_language_id_learns_from_every_labelled_row(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "zz", "wuzu kawa lumo " * 5) for i in held]              # all in the part that op4 holds out
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert sorted(r.doc_id for r in cp.language_id(spark, docs, SF).collect()) == held


def test_language_id_holds_little_beside_its_batch():
    words = [f"{a}{b}ol{c}e" for a in "abcdefgh" for b in "aeiou" for c in "mnrst"]
    text = " ".join(words[i * i % len(words)] for i in range(1000))
    batch = pa.RecordBatch.from_arrays([pa.array(["xx"] * 600), pa.array([text] * 600)], ["lang", "text"])
    sums = {}
    langid._letters()
    tracemalloc.start()
    for out in langid._count(iter([batch])):
        sums = dict(zip(out.column(1).to_pylist(), out.column(2).to_pylist()))
    counted = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    k, n = np.unique(langid.grams([text])[0], return_counts=True)
    assert batch.nbytes > 3 << 20 and counted < 24 << 20
    assert sums == dict(zip(k.view(np.int64).tolist(), (600 * n).tolist()))


def test_workers_of_other_stages_drop_the_vocabularies():
    docs = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["one two three four five six"])], ["doc_id", "text"])
    for stage in (langid._count, langid._grams_of, jaccard._profile):
        ids, _ = tokens.id_rules(tokens.vocabulary(tokens.BYTES)).ids(docs.column(1))
        assert len(ids) and tokens.id_rules.cache_info().currsize == 1
        list(stage(iter([])))
        assert tokens.id_rules.cache_info().currsize == 0


def test_language_codes_start_no_python_workers(spark, capsys):
    counts = spark.range(3).selectExpr("'aa' lang", "id gram", "id n")
    coded = langid._coded(counts, ["aa", "bb"])
    coded.explain()
    assert "ExistingRDD" not in capsys.readouterr().out
    assert sorted(map(tuple, coded.collect())) == [(0, 0, 0), (0, 1, 1), (0, 2, 2)]
    assert langid._coded(counts, []).schema == coded.schema and langid._coded(counts, []).count() == 0
