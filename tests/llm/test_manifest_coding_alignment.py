"""Merkle manifest, byte-pair coding and alignment against plain Python or the vocabulary's own library."""

import hashlib
import random
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortcast.llm import align, merges, merkle, queries, tokens
from cohortcast.llm.common import prepare, table
from cohortcast.llm.pieces import groups

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, lang string, n_chars long, text string, pos string, node long, root string, row string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(digests):
    """Root and, for each leaf, (before, after) level by level."""
    paths, place, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, p in enumerate(place):
            other = level[p ^ 1] if p ^ 1 < len(level) else ""
            paths[k].append((other, "") if p % 2 else ("", other))
            place[k] = p >> 1
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r, plain_leaf(r[:5])))
    for x in by.values():
        x.sort(key=lambda y: (y[0][0] is not None, y[0][0] or 0, y[1]))
    names = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = [plain_tree([d for _, d in by[k]]) for k in names]
    root, above = plain_tree([t[0] for t in trees])
    out = []
    for k, (sub, paths), top in zip(names, trees, above):
        for (r, d), path in zip(by[k], paths):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            x = plain_leaf((*r[:3], r[3] + 1, r[4])) if bad else d
            for a, b in path + top:
                x = h(a, x, b)
            out.append((r[0], d, sub, root, h(*[a + b for a, b in path + top]), x, x == root))
    return sorted(out, key=repr)


def manifest_rows(n=120):
    r = random.Random(2)
    rows = [(i, r.choice(["a", None, "é"]), r.choice(["de", "de", "de", "fr", None, "é", "Z"]), r.choice([None, i, 0]),
             r.choice([None, "", "x" * i, "naïve 日本"]), "p", 1, "r", "w") for i in range(n)]
    rows += [rows[5], rows[5], (None, None, None, None, None, "p", 1, "r", "w"), (7, "b", "de", 3, "again", "p", 1, "r", "w")]
    return rows + [(1000 + i, "s", "only", 1, "t", "p", 1, "r", "w") for i in range(1)]


def registered(docs):
    """The registered query's columns over any documents."""
    bad = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    changed = merkle.leaf(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    out = merkle.manifest(docs, also={"changed": F.when(bad, changed)}, digits=1)
    root = merkle.folded(F.coalesce("changed", "leaf"), F.col("steps"))
    return out.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("steps")), root, root == F.col("root"))


def test_manifest_equals_plain_tree(spark):
    prepare(spark)
    rows = manifest_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    # one digit a block: several passes over blocks of 32
    assert sorted(map(tuple, registered(docs).collect()), key=repr) == plain_manifest(rows)


def test_manifest_query_equals_plain_tree(spark):
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
           for r in queries.op11_merkle_manifest(spark, SF).collect()]
    assert sorted(got, key=repr) == plain_manifest(rows)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_of_nothing(spark):
    prepare(spark)
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []


# ---- byte-pair coding ---------------------------------------------------------------------------------

BITS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", " ", "\u0085", " ", "é", "é", "́", " ́", "Σ", "ς", "İ",
        "ß", "ﬁ", "日本", "한", "가", "1", "23", "'s", "'S", "'ll", "''", "<|endoftext|>", "<|startoftext|>", "<|end", "|>",
        "!", "...", "👍", "👩‍👩‍👧", "\x00", "\x1c", "\x7f", "A", "ǅ", "K", "Å", "x" * 30, "</w>", "Ġ", "▁", "²", "½", "٣", "<s>",
        "</s>", "<unk>", "<0x41>", "aaa", " lead"]


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(BITS) for _ in range(r.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def words():
    from tokenizers import Tokenizer
    path = tokens.vocabulary(merges.WORDS)
    return Tokenizer.from_file(path), merges.Codec(path), path


def test_segment_tree_merges_lowest_leftmost():
    r = random.Random(4)
    for _ in range(300):
        pairs = {(r.randrange(6), r.randrange(6)) for _ in range(12)}
        rules = {p: (k, r.randrange(6)) for k, p in enumerate(sorted(pairs, key=lambda _: r.random()))}
        sym = [r.randrange(6) for _ in range(r.randint(0, 25))]
        want = list(sym)
        while True:
            found = [(rules[p][0], i) for i, p in enumerate(zip(want, want[1:])) if p in rules]
            if not found:
                break
            i = min(found)[1]
            want[i:i + 2] = [rules[want[i], want[i + 1]][1]]
        assert merges.merged(sym, rules) == want


@pytest.mark.parametrize("most", [1 << 19, 40])
def test_ids_and_text_equal_the_library(words, most):
    library, codec, _ = words
    texts = odd_texts(3000, 1) + ["word " * 50_000, "x" * 30_000]
    ids = {i: [] for i in range(len(texts))}
    for rows, data, _ in groups(pa.array(texts), most=most):
        got, first = codec.ids(data)
        for k, row in enumerate(rows):
            ids[row] += got[first[k]:first[k + 1]].tolist()
    for i, x in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[i] == x.ids, texts[i][:200]
        assert not x.ids or codec.decode(x.ids) == library.decode(x.ids, skip_special_tokens=False)


def test_coding_digests_and_pieces(spark, words):
    prepare(spark)
    library, _, path = words
    rows = list(enumerate([None, "", "  \n ", *odd_texts(200, 9), "lo ng " * 2000])) + [(3, "twice"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame([(i, t, "7", 1) for i, t in rows], "doc_id long, text string, ids string, piece long").repartition(3)

    def plain(i, t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return (i, len(ids), h(" ".join(map(str, ids))), h(library.decode(ids, skip_special_tokens=False)))
    want = sorted([plain(i, t) for i, t in rows], key=repr)
    assert sorted(map(tuple, merges.digests(docs, path).collect()), key=repr) == want
    whole = {}
    for r in merges.coded(docs.where("doc_id > 3"), path, 50).orderBy("doc_id", "piece").collect():
        whole.setdefault(r["doc_id"], []).extend(r["ids"])
    assert {i: len(x) for i, x in whole.items()} == {i: n for i, n, *_ in want if i is not None and i > 3}
    assert merges.digests(docs.limit(0), path).collect() == []


# ---- alignment ----------------------------------------------------------------------------------------

def byte_of():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = tokens.vocabulary(tokens.BYTES), tokens.vocabulary(tokens.PIECES)
    of_a = Tokenizer.from_file(a)
    of_a.encode_special_tokens = True
    return of_a, sentencepiece.SentencePieceProcessor(model_file=b), a, b


def spans(of_a, of_b, text):
    if not text:
        return None
    letter, raw, out = byte_of(), (" " + text).encode(), []
    a = [(i, bytes(letter[c] for c in of_a.id_to_token(i))) for i in of_a.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(of_b.id_to_piece(i)[3:5], 16)]) if of_b.is_byte(i) else of_b.id_to_piece(i).replace("▁", " ").encode())
         for i in of_b.encode(text)]
    for x in (a, b):
        if b"".join(y for _, y in x) != raw:
            return None
        at, places = 0, []
        for i, y in x:
            places.append((at, at + len(y), i))
            at += len(y)
        out.append(places)
    return out


def plain_alignment(rows, of_a, of_b):
    per = []
    for d, t in rows:
        found = spans(of_a, of_b, t)
        if found is None:
            per.append((d, None))
            continue
        a, b = found
        links, parts, i, j = Counter(), [([], [])], 0, 0
        while i < len(a):
            links[a[i][2], b[j][2]] += 1
            ends = a[i][1], b[j][1]
            if ends[0] <= ends[1]:
                parts[-1][0].append(a[i][2])
                i += 1
            if ends[1] <= ends[0]:
                parts[-1][1].append(b[j][2])
                j += 1
            if ends[0] == ends[1]:
                parts.append(([], []))
        text = ";".join("|".join(",".join(map(str, x)) for x in p) for p in parts[:-1])
        per.append((d, (len(a), len(b), len(parts) - 1, links, text)))
    docs = Counter(k for _, x in per if x for k in x[3])
    best = Counter()
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for d, x in per:
        if x is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((d, *x[:3], sum(x[3].values()), sum(n for k, n in x[3].items() if docs[k] == best[k[0]]),
                        sum(n * docs[k] for k, n in x[3].items()), h(x[4])))
    return sorted(out, key=repr), docs


@pytest.mark.parametrize("hot, most", [(500_000, None), (50, 37)])
def test_alignment_equals_plain_links(spark, both, hot, most):
    prepare(spark)
    of_a, of_b, a, b = both
    rows = [*enumerate(odd_texts(800, 3)), (5, None), (6, ""), (7, "said twice"), (7, "said twice"), (None, "abc def"), (None, None)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, row string, n long").repartition(3)
    out, pairs = align.aligned(docs, a, b, hot, most)
    want, counts = plain_alignment(rows, of_a, of_b)
    assert sorted(map(tuple, out.collect()), key=repr) == want
    assert {(r["a"], r["b"]): r["docs"] for r in pairs.collect()} == counts
    assert any(w[-1] == "" for w in want)


def test_alignment_query_and_nothing(spark, both):
    of_a, of_b, a, b = both
    docs = table(spark, SF, "documents")
    want, _ = plain_alignment([(r["doc_id"], r["text"]) for r in docs.collect()], of_a, of_b)
    assert sorted(map(tuple, queries.op13_tokenizer_alignment(spark, SF).collect()), key=repr) == want
    assert align.aligned(docs.limit(0), a, b)[0].collect() == []
