"""Each operator against a plain Python version, on rows with nulls, empty, short, long, repeated and clashing data."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortcast.llm import (chat, decontaminate, jaccard, langid, packing, pii, queries, substring, suffixes, tokens, windows,
                            topk)
from cohortcast.llm.common import components, prepare, written

SF = "/root/testdata/sf0.001"
WS = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("n", T.StringType()),
                       T.StructField("component", T.LongType()), T.StructField("spans", T.StringType()),
                       T.StructField("pii", T.LongType()), T.StructField("rank", T.StringType())])


def texts() -> list[tuple[int | None, str | None]]:
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["né", "Straße", "日本語", "x\x1cy", "a b", "▁"]
    doc = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base = [doc(r.randint(0, 90)) for _ in range(60)]
    passage, line = doc(60), doc(25)
    out = [None, "", "   \n ", "one", "one two three", "One TWO three", "the same four words", "the same  four\twords"]
    out += base
    for t in base[:25]:                                         # near copies: a word or two changed
        w = t.split(" ")
        if len(w) > 12:
            for _ in range(r.randint(1, 3)):
                v = list(w)
                for _ in range(r.randint(1, 2)):
                    v[r.randrange(len(v))] = "changed" + str(r.randrange(4))
                out.append(" ".join(v))
    out += base[5:9] + base[5:9]
    out += [doc(10) + "\n" + passage + "\n" + doc(8) for _ in range(7)]
    out += [line * 3, (line + " ") * 5, "ab" * 400, "ab" * 150, "x" * 500, "né" * 120, doc(3000) + " " + passage]
    out += ["<|endoftext|> hello <|endoftext|>x  y", " lead", "trail ", "a\n\n b\n c  d\n", "<s> </s>　z\r\n\x00q"]
    rows = list(enumerate(out))
    rows += [rows[20], (None, base[3]), (None, None)]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    prepare(spark)
    df = spark.createDataFrame([(i, t, "xx", "n", 7, "s", 1, "r") for i, t in rows], SCHEMA).repartition(5)
    return written(df, "docs")


def bwords(t, lower=False):
    b = (t or "").encode()
    return WS.findall(b.lower() if lower else b)


def shingles(t):
    w = bwords(t, True)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def by_id(df, *cols):
    return sorted(((r["doc_id"], *(r[c] for c in cols)) for r in df.collect()), key=repr)


def test_jaccard_components(docs, rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    want = sorted(((i, len(shingles(t)), find(i) if i is not None else None) for i, t in rows), key=repr)
    got = by_id(jaccard.jaccard_components(docs), "n_shingles", "component_id")
    assert got == want
    assert len({c for _, _, c in want}) < len(sets)


def test_trie_overlaps_agrees_with_sets():
    r = random.Random(1)
    for _ in range(200):
        universe = list(range(1, 60))
        probe = sorted(r.sample(universe, r.randint(1, 40)))
        others = sorted({tuple(sorted(set(r.sample(universe, r.randint(1, 40))) if r.random() < .5 else
                                      set(probe) ^ set(r.sample(universe, r.randint(0, 6))) or {1})) for _ in range(12)})
        raw = [np.array(o, ">u8").tobytes() for o in others]
        got = jaccard.trie_overlaps(np.array(probe, np.uint64), raw)
        assert got == [100 * len(set(probe) & set(o)) >= 75 * len(set(probe) | set(o)) for o in others]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(300, 299), (5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {299: 299, 300: 299}
    assert got == want


def test_decontamination(spark, docs, rows):
    texts = [t for _, t in rows if t and len(bwords(t)) > 20][:6]
    items = [(i, " ".join(t.split()[3:3 + 14 + i])) for i, t in enumerate(texts)]
    items += [(50, None), (51, ""), (52, "one two three"), (53, "nothing like this is there at all"), (52, "one two three")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained(
        docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    low = lambda t: {tuple(s) for s in _strings(t)}
    held = defaultdict(set)
    for i, t in rows:
        if i is not None:
            held[i] |= low(t)
    want = {(i, k) for i, s in held.items() for k, t in items if low(t) and 4 * len(low(t) & s) >= 3 * len(low(t))}
    assert got == want and len(want) > 6


def _strings(t):
    w = [x for x in re.split("[ \t\n\x0b\f\r]+", (t or "").lower()) if x]
    return [w[i:i + 5] for i in range(len(w) - 4)] if len(w) >= 5 else [w] * bool(w)


def test_exact_top_k(spark):
    r = np.random.default_rng(3)
    vecs = [(i, [float(x) for x in r.normal(size=8)]) for i in range(400)]
    vecs += [(400, None), (401, []), (402, [1.0, None] + [0.0] * 6), (403, [float("nan")] * 8), (404, [float("inf")] * 8),
             (405, [1.0] * 7), (500, [0.0] * 8), (501, vecs[7][1]), (502, vecs[7][1]), (None, [1.0] * 8), vecs[9]]
    df = spark.createDataFrame([(i, v, "x") for i, v in vecs], "vec_id long, embedding array<double>, score string")
    good = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in vecs
            if i is not None and v and None not in v and np.isfinite(v).all()}
    for k in (10, 1000):
        got = sorted(tuple(x) for x in topk.exact_top_k(df, F.col("vec_id") % 100 == 0, k).collect())
        want = []
        for q in (i for i in good if i % 100 == 0):
            best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:k]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
        assert got == sorted(want)


def _substring(rows, symbols, w, join):
    """What must stay of each row; symbols: text -> row of symbols."""
    places = defaultdict(list)
    seqs = [(i, symbols(t)) for i, t in rows]
    for i, s in seqs:
        if i is not None:
            for p in range(len(s) - w + 1):
                places[join(s[p:p + w])].append((i, p))
    out = []
    for i, s in seqs:
        gone = set()
        if i is not None:
            for p in range(len(s) - w + 1):
                if min(places[join(s[p:p + w])]) < (i, p):
                    gone.update(range(p, p + w))
        out.append((i, s, gone))
    return out


def test_substring_dedup(docs, rows):
    want = sorted(((i, len(s), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(s) if p not in gone)).hexdigest())
                   for i, s, gone in _substring(rows, bwords, 20, tuple)), key=repr)
    assert by_id(substring.substring_dedup(docs), "n_words", "n_removed", "kept_sha256") == want
    assert sum(x[2] for x in want) > 300


def test_suffix_dedup(docs, rows):
    want = []
    for i, s, gone in _substring(rows, lambda t: (t or "").encode(), 100, bytes):
        spans = sum(p - 1 not in gone for p in gone)
        kept = bytes(x for p, x in enumerate(s) if p not in gone)
        want.append((i, len(s), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = by_id(suffixes.suffix_dedup(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(want, key=repr) and sum(x[2] for x in want) > 1000


def test_hot_anchors_are_split_to_the_same_result(docs, spark):
    """A line that nearly all documents hold between different neighbours: split at once, or never."""
    r = random.Random(11)
    line = " ".join(f"line{i}" for i in range(14))
    rows = [(i, " ".join([f"a{r.randrange(40)}" for _ in range(r.randrange(9))] + [line]
                         + [f"b{r.randrange(3)}" for _ in range(r.randrange(9))])) for i in range(300)]
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    places = lambda runs: sorted({(x.doc, x.start + k) for x in runs.collect() for k in range(x.n)})
    for source in (docs.select("doc_id", "text"), many):
        for find in (substring.repeated_windows, suffixes.repeated_strings):
            got = places(find(source.where("doc_id is not null"), hot_least=2))
            assert got == places(find(source, hot_least=1 << 40)) and got
    for find, w, symbols, join in ((substring.repeated_windows, 20, bwords, tuple),
                                   (suffixes.repeated_strings, 100, str.encode, bytes)):
        first, want = {}, []
        for i, t in rows:
            s = symbols(t)
            for p in range(len(s) - w + 1):
                if first.setdefault(join(s[p:p + w]), (i, p)) != (i, p):
                    want.append((i, p))
        assert places(find(many, hot_least=2)) == want


def test_frequent_anchors_are_found_over_tasks(spark, docs):
    many = spark.range(0, 4000, 1, 5).select(F.col("id").alias("doc_id"), F.lit("word " * 30).alias("text"))
    flags = windows.repeat_flags(many, substring._anchors_of, 4000, 1000).value
    assert len(flags.hot) == 1 and flags(flags.hot).all()
    assert not len(windows.repeat_flags(many, substring._anchors_of, 4000, 1 << 30).value.hot)


def test_column_rounds_give_suffix_order_and_common_prefixes():
    r = np.random.default_rng(2)
    group = np.sort(r.integers(0, 6, 60))
    cols = r.integers(97, 99, (60, 14)).astype(np.uint8)
    cols[r.random((60, 14)) < .02] = 255
    for c, order, common in suffixes.equal_strings(group, cols, 9):
        keys = [(group[i], cols[i, c:].tobytes(), i) for i in range(60)]
        assert [keys[i][:2] for i in order] == [k[:2] for k in sorted(keys)]
        for k in range(1, 60):
            a, b = keys[order[k - 1]], keys[order[k]]
            n = next((x for x in range(len(a[1])) if a[1][x] != b[1][x]), len(a[1]))
            assert common[k] == (0 if a[0] != b[0] else min(n, 9))


def test_language_models_are_distributions_and_predict(spark, docs):
    corpus = ["the cat and the hat", "a hat that sat", "cats and hats"]
    k, _ = langid.grams(corpus)
    u, n = np.unique(k, return_counts=True)
    levels = langid.kneser_ney(u, n)
    letters = levels[0].grams
    for ctx in list(np.unique(u >> np.uint64(16)))[:20] + [np.uint64(0x7A007A007A)]:
        p = np.exp(langid.log_probability(levels, (ctx << np.uint64(16)) | np.append(letters, np.uint64(0x3042))))
        assert abs(p.sum() - 1) < 1e-9                          # all letters known, and one for those never seen
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(table.where(langid.in_training()))
    got = langid.identify(table, model).where(~langid.in_training()).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    assert sum(r.rejected for r in got) <= 0.02 * len(got)
    some = spark.createDataFrame([(1, None), (2, ""), (3, "123 %"), (4, "日本語" * 30), (5, "x")], "doc_id long, text string")
    odd = {r.doc_id: r for r in langid.identify(some, model).collect()}
    assert [odd[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(odd[i].rejected for i in (1, 2, 3, 4))
    assert odd[5].lang_pred in model.languages and all(0 <= r.lang_score <= 1 for r in got)
    empty = langid.fit(docs.where("false"))
    assert {r.lang_pred for r in langid.identify(docs.select("doc_id", "text"), empty).collect()} == {"und"}


def test_language_models_keep_every_gram_and_score_alike_by_tables(spark, monkeypatch):
    r = random.Random(3)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    words = ["".join(r.choice(letters) for _ in range(4)) for _ in range(90_000)]
    long = [(i, "zh", " ".join(words[i * 900:(i + 1) * 900])) for i in range(100)]
    model = langid.fit(spark.createDataFrame(long, "doc_id long, lang string, text string").repartition(4))
    assert len(model.levels[0][-1].grams) > 300_000                             # nothing is cut
    k, _ = langid.grams([t for _, _, t in long])
    assert np.array_equal(model.levels[0][-1].grams, np.unique(k))
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    some = table.limit(60).unionByName(spark.createDataFrame([(None, "xx", None), (-1, "xx", "12 %"), (-2, "xx", "日本 x"),
                                                              (-2, "xx", "日本 x")], table.schema))
    ask = lambda m: sorted(((r.doc_id, r.lang_pred, r.lang_score, r.entropy, r.rejected)
                            for r in langid.identify(some, m).collect()), key=repr)
    one = langid.fit(table)
    monkeypatch.setattr(langid, "BROADCAST_GRAMS", 0)
    two = langid.fit(table)
    assert isinstance(two, langid.Tables) and not isinstance(one, langid.Tables)
    assert np.allclose(one.mean, two.mean) and np.allclose(one.spread, two.spread)
    for x, y in zip(ask(one), ask(two), strict=True):
        assert x[:2] == y[:2] and x[4] == y[4] and np.allclose(x[2:4], y[2:4], equal_nan=True)


def test_prefix_tokens_travel_in_six_bytes_as_planes():
    x = np.random.default_rng(5).integers(0, 1 << 48, 300).astype(np.uint64)
    raw = jaccard.planes(x, jaccard.TOKEN_BYTES)
    assert len(raw) == 6 * len(x) and np.array_equal(jaccard.from_planes(raw, jaccard.TOKEN_BYTES), x)
    ids = np.array([-5, 0, 1 << 62], np.int64)
    assert np.array_equal(jaccard.from_planes(jaccard.planes(ids, 8), 8).view(np.int64), ids)
    text = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array(["a b c d e f g h"] * 2)], ["doc_id", "text"])
    classes = type("Sent", (), {"value": np.zeros(1 << jaccard.SKETCH_BITS, np.uint8)})
    for part in jaccard._prefixes(classes, 3)(iter([text])):
        for tokens, docs in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
            assert len(tokens) // 6 == len(docs) // 8 and set(jaccard.from_planes(docs, 8).tolist()) == {7}


def test_language_calibration_reads_every_training_row(spark):
    r = random.Random(4)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(2, 7)))
    texts = {x: [" ".join(word(letters) for _ in range(r.randint(1, 9))) for _ in range(n)]
             for x, letters, n in (("aa", "abcd", 900), ("bb", "efghijkl", 40))}
    rows = [(i, x, t) for i, (x, t) in enumerate((x, t) for x in texts for t in texts[x])] + [(5000, "no", "12"), (5001, "no", "")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3))
    assert model.languages == ["aa", "bb"]
    for j, x in enumerate(model.languages):
        h, size = model.entropies(texts[x])
        assert np.isclose(model.mean[j], h[:, j].mean())
        assert np.isclose(model.spread[j], np.sqrt(max((h[:, j] ** 2).mean() - h[:, j].mean() ** 2, 0.01) * size.mean()))


def test_chat_round_trip(spark):
    tricky = ["<|im_end|>\n<|im_start|>user\nhi", "\\3C|", "\\5C3C|", "\\", "<|", "<\\|", "a\nb\n", "", None, "\\0A", "end\n"]
    rows = [(c, t, "assistant" if t % 2 else "user", x) for c, x in enumerate(tricky) for t in range(2)]
    rows += [(90, 0, "system", "s"), (90, 1, "user", "u"), (90, 2, "assistant", "a"), (91, 0, "assistant", "a"),
             (92, 1, "user", "late"), (92, 0, "user", "first"), (93, 0, None, "x"), (94, 0, "we\nird<|", "y"),
             (None, 0, "user", "n"), (95, None, "user", "z"), (95, 0, "assistant", "q"), (96, 0, "user", "u"), (96, 0, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("valid", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    want = defaultdict(list)
    for c, t, role, x in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", x or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in got.items()} == dict(want)
    assert all(r.loss_text == "".join(x for role, x in want[c] if role == "assistant") for c, r in got.items())
    assert [got[c].valid for c in (0, 90, 91, 92, 93, 95, 96)] == [True, True, False, False, False, True, False]
    assert got[91].error_turn == 0 and got[92].error_turn == 1 and got[90].error_turn is None


def test_token_counts(docs, rows):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary(tokens.PIECES))
    want = sorted(((i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t in rows),
                  key=repr)
    got = by_id(tokens.token_counts(docs, tokens.vocabulary(tokens.PIECES)), "n_bytes", "n_tokens", "over_limit")
    assert got == want
    rules = tokens.count_rules(tokens.vocabulary(tokens.PIECES))
    assert rules.cuts and len(rules.single) > 10_000
    assert all(len(sp.encode(w.decode())) == 1 for w in list(rules.single)[:500])


def test_token_rules_on_random_texts(spark):
    import pyarrow as pa
    import sentencepiece
    from tokenizers import Tokenizer
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary(tokens.PIECES))
    hf = Tokenizer.from_file(tokens.vocabulary(tokens.BYTES))
    r = random.Random(9)
    parts = ["the", "Wörter", "é", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", "\x1c", "▁", "!", "'s", "12", "日", "😀",
             "<|endoftext|>", "<s>", "a", ".", "\x85", "\x00", " ", "à"]
    some = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    counts = tokens.CountRules(tokens.vocabulary(tokens.PIECES)).counts(pa.array(some))
    assert counts.tolist() == [len(x) for x in sp.encode(some)]
    ids, offs = tokens.IdRules(tokens.vocabulary(tokens.BYTES)).ids(pa.array(some))
    assert [ids[a:b].tolist() for a, b in zip(offs, offs[1:])] == [hf.encode(t, add_special_tokens=False).ids for t in some]
    small = tokens.Units(tokens.CountRules(tokens.vocabulary(tokens.PIECES)).encode, most=3)      # a table that overflows
    rules = tokens.CountRules(tokens.vocabulary(tokens.PIECES))
    rules.units = small
    for i in range(0, 400, 40):
        assert rules.counts(pa.array(some[i:i + 40])).tolist() == [len(x) for x in sp.encode(some[i:i + 40])]


def test_pseudonyms(spark):
    def luhn(s):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    body = "card 4041894974608795 and 4041-8949-7460-8795, not 4041894974608796. Mail bosbt.42@mail8.example.com or A.b@x.org; " \
           "host 42.144.35.254 not 42.144.35.999; call +1 (988) 555-2485 or 988-555-2485; born 1984-02-29, 1985-02-30, " \
           "29.02.1984 and 02/29/1984. Version 4.0 of 12.\n"
    rows = [(1, body), (2, None), (3, ""), (4, "no such thing"), (5, body), (None, "4041894974608795"), (6, "7@8"),
            (7, "x 4041894974608795\n42.144.35.254.")]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, kind string")
    got = {r.doc_id: r for r in pii.pseudonymised(df, "key").collect()}
    t = got[1].text
    assert [v.kind for v in got[1].pii] == ["card", "card", "email", "email", "ipv4", "phone", "phone", "date", "date", "date"]
    assert got[5].text == t and got[2].text is None and [got[i].text for i in (3, 4, 6)] == ["", "no such thing", "7@8"]
    assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d+", "9", t))) == \
        re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d+", "9", body)))
    c1, c2, m1, m2, ip, p1, p2, d1, d2, d3 = [v.value for v in got[1].pii]
    assert luhn(c1) and c1 == c2.replace("-", "") and c1 != "4041894974608795" and got[None].text == c1
    assert re.fullmatch(r"[a-z]{5}\.\d\d@mail8\.example\.com", m1) and re.fullmatch(r"[A-Z]\.[a-z]@x\.org", m2)
    assert all(0 <= int(x) < 256 for x in ip.split(".")) and ip in got[7].text and c1 in got[7].text
    assert re.sub(r"\D", "", p1)[1:] == re.sub(r"\D", "", p2) and p1.startswith("+1 (")
    y, m, d = d1.split("-")
    assert (d2, d3) == (f"{d}.{m}.{y}", f"{m}/{d}/{y}") and "1985-02-30" in t and "4041894974608796" in t
    assert {r.doc_id: r.kind for r in got.values()}[1] == "k"


def test_cards_beside_other_numbers(spark):
    card, groups = "4041894974608795", "4041 8949 7460 8795"
    rows = [card, f"{card} 12/27", f"12 {card}", f"{groups} 12/27 123", f"7 {groups}", f"{card} 988-555-2485",
            f"{card} 02/29/1984", f"{card} 34 {card}", "40418 949746087 95", f"\uffff {card} 12/27", f"\uffff{card}\uffff",
            f"{card} 988 555-2485", "4041894974608796 12", "988-555-2485", "02/29/1984"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: (r.text, [v.kind for v in r.pii], [v.value for v in r.pii])
           for r in pii.pseudonymised(df, "key").collect()}
    hid, phone, day = got[0][0], got[13][0], got[14][0]
    spaced = " ".join(hid[i:i + 4] for i in range(0, 16, 4))
    want = [hid, f"{hid} 12/27", f"12 {hid}", f"{spaced} 12/27 123", f"7 {spaced}", f"{hid} {phone}", f"{hid} {day}",
            f"{hid} 34 {hid}", f"{hid[:5]} {hid[5:14]} {hid[14:]}", f"\uffff {hid} 12/27", f"\uffff{hid}\uffff", None, rows[12]]
    assert hid != card and [got[i][0] for i in range(13) if i != 11] == [w for w in want if w is not None]
    assert got[11][0].startswith(hid + " ") and got[11][1] == ["card", "phone"] and "2485" not in got[11][0]
    assert got[5][1] == ["card", "phone"] and got[7][1] == ["card", "card"] and got[12][1] == []
    assert got[3][2] == [spaced]


def test_permutations_are_one_to_one(spark):
    days = spark.range(146097).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")),
                                                    "yyyy-MM-dd").alias("m"))
    out = days.select(pii._date(F.col("m"), "k").alias("p"))
    assert out.agg(F.count_distinct("p"), F.min("p"), F.max("p")).first()[:] == (146097, "1800-01-01", "2199-12-31")
    four = spark.range(10000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("m"))
    assert four.select(pii._digits(F.col("m"), "k", "x").alias("p")).distinct().count() == 10000


def test_packing(docs, rows):
    from tokenizers import Tokenizer
    hf = Tokenizer.from_file(tokens.vocabulary(tokens.BYTES))
    capacity = 256
    path = tokens.vocabulary(tokens.BYTES)
    out = packing.pack_pieces(written(packing.token_pieces(docs, path, capacity), "pieces"), capacity).collect()
    want = []
    for i, t in rows:
        ids = hf.encode(t or "", add_special_tokens=False).ids + [0]
        cut = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            want.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)
    check_sequences([(r.sequence_id, r.offset, r.length) for r in out], capacity, 0.04)


def check_sequences(rows, capacity, slack):
    by = defaultdict(list)
    for s, o, n in rows:
        by[s].append((o, n))
    for x in by.values():
        at = 0
        for o, n in sorted(x):
            assert o == at
            at += n
        assert at <= capacity
    total = sum(n for _, _, n in rows)
    assert len(by) <= np.ceil(total / capacity) * (1 + slack) + 1


def test_plan_places_every_piece_once():
    r = random.Random(4)
    for case in range(6):
        hist = {r.randint(1, 2048): r.randint(1, 500 if case % 2 else 5) for _ in range((1, 5, 200, 900, 2, 2000)[case])}
        hist[2048] = 3
        rows, made = packing.plan(dict(hist))
        seen = defaultdict(list)
        out = []
        for length, lo, hi, first, offset in rows:
            seen[length].append((lo, hi))
            out += [(first + k, offset, length) for k in range(hi - lo)]
        for length, n in hist.items():
            spans = sorted(seen[length])
            assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        check_sequences(out, 2048, 0.1 if case > 1 and case != 4 else 1)
        assert len({s for s, _, _ in out}) == made


def test_empty_tables(spark, docs):
    none = docs.where("false")
    assert jaccard.jaccard_components(none).count() == 0
    assert decontaminate.contained(none, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
    assert substring.substring_dedup(none).count() == 0 and suffixes.suffix_dedup(none).count() == 0
    assert tokens.token_counts(none, tokens.vocabulary(tokens.PIECES)).count() == 0
    assert packing.pack_documents(none, tokens.vocabulary(tokens.BYTES)).count() == 0
    assert pii.pseudonymised(none, "k").count() == 0
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_registered_queries_have_their_columns(spark):
    got = queries.op6_chat_format(spark, SF).where("conv_id = -1").first()
    assert got.n_turns == 2 and got.loss_chars == len("<|im_end|><|im_start|>assistant ok")
