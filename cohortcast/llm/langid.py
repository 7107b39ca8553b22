"""Operator 4: language identification by interpolated Kneser-Ney character models.

Each language has a character model of order four with absolute discounting, interpolated down to single characters by
continuation counts.  Counts are gathered over all training rows by Spark (partial counts per task, then sums by
language and n-gram).  Models are stored as sorted arrays of n-gram keys with their log-probabilities and
back-off weights; a lookup is a binary search.  A text gets the language of lowest cross-entropy per character; ``score`` is
the softmax of the negative cross-entropies, scaled by ``SHARPNESS`` characters.  Rejection is calibrated: a text whose cross-entropy
lies further above its language's calibration mean than any clean text should (see ``Model.limit``) is rejected, as are texts
without a letter.

Every four-gram of the training rows is kept.  Up to ``BROADCAST_GRAMS`` of them (all languages together) the model is
sent to the tasks; beyond it (``Tables``) discounts, continuation counts and probabilities of all orders are computed in
Spark and written, the texts' distinct grams are joined with them, and each text's grams with the result.

Counts and calibration read all training rows; a calibration row is only scored by its own language's model.

Texts are lower-cased; each character that is not a letter counts as a space, runs of spaces as one.  Characters are
taken modulo 2 ** 16, so an n-gram is one 64-bit key.

Edge cases: null text or text without a letter: ``und``, score 0, rejected; a training table without usable rows: every
row is ``und``; ties between languages go to the alphabetically first; rows that repeat count each time; null
language or null doc_id rows are not learned from; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, forget, join_checked, slices, written

ORDER = 4
#: Four-grams of a model that may be broadcast (about 60 bytes each in a task's arrays); beyond it scoring joins.
BROADCAST_GRAMS = 4_000_000
SHARPNESS = 40
CHUNK = 1 << 18             # bytes of text whose characters are held as arrays at once (some 60 bytes each)


@functools.cache
def _letters() -> np.ndarray:
    """For each code point: its letter modulo 2 ** 16, or a space."""
    out = np.full(0x110000, 32, np.uint16)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            out[c] = c % 65536 or 1
    return out


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' characters, each text as `` word word ``, and each text's first index."""
    parts = [(" " + t.lower() + " ") if t else " " for t in texts]
    raw = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(p) for p in parts])
    c = _letters()[raw]
    first = np.zeros(len(c), bool)
    first[np.r_[0, ends[:-1]]] = True
    keep = (c != 32) | first | np.r_[True, c[:-1] != 32]
    offs = np.r_[0, np.cumsum(keep)[ends - 1]] if len(parts) else np.zeros(1, np.int64)
    return c[keep], offs


def keys(c: np.ndarray, n: int) -> np.ndarray:
    """The n-gram that ends at each character, as a 64-bit key; those before the first have zeros."""
    c = c.astype(U64)
    out = c.copy()
    for j in range(1, n):
        out[j:] |= c[:-j] << U64(16 * j)
    return out


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Four-gram keys that end at each character after a text's opening space, and each text's first index.
    What lies before the opening space is zero."""
    c, offs = characters(texts)
    k = keys(c, ORDER)
    at = np.arange(len(c)) - np.repeat(offs[:-1], np.diff(offs))        # characters before, in the same text
    for j in range(min(ORDER - 1, 3)):
        short = at == j
        k[short] &= U64((1 << (16 * (j + 1))) - 1)
    keep = at > 0
    return k[keep], np.r_[0, np.cumsum(keep)][offs]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    held: dict[str, list] = {}

    def flush(lang):
        k, n = zip(*held.pop(lang))
        k, n = np.concatenate(k), np.concatenate(n)
        u, at = np.unique(k, return_inverse=True)
        return u, np.bincount(at, weights=n).astype(np.int64)

    def row(lang, u, n):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u.view(np.int64)), pa.array(n)],
                                          ["lang", "gram", "n"])
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            langs = np.array(part.column(0).to_pylist(), object)
            texts = part.column(1).to_pylist()
            for lang in sorted(set(langs)):
                k, _ = grams([texts[i] for i in np.flatnonzero(langs == lang)])
                held.setdefault(lang, []).append(np.unique(k, return_counts=True))
                if len(held[lang]) > 16:
                    u, n = flush(lang)
                    if len(u) > 1_000_000:
                        yield row(lang, u, n)
                    else:
                        held[lang] = [(u, n)]
    for lang in sorted(held):
        yield row(lang, *flush(lang))


@dataclass
class Level:
    """One order of a model: sorted n-grams with log-probabilities, sorted contexts with log back-off weights."""
    grams: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


def _find(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, key), max(len(table) - 1, 0))
    return at, (table[at] == key) if len(table) else np.zeros(len(key), bool)


def _mask(n: int) -> np.uint64:
    return U64((1 << (16 * n)) - 1)


def kneser_ney(gram: np.ndarray, count: np.ndarray) -> list[Level]:
    """Interpolated Kneser-Ney levels 1 to ORDER from the counts of ORDER-grams (leading zeros: text starts)."""
    levels: list[Level] = []
    tables = []
    k, n = gram, count.astype(float)
    for order in range(ORDER, 0, -1):
        u, at = np.unique(k & _mask(order), return_inverse=True)
        total = np.bincount(at, weights=n) if order == ORDER else np.bincount(at).astype(float)
        tables.append((u, total))
        k, n = u, total                                 # the next order counts the distinct continuations
    below_logp = None
    for order, (u, n) in zip(range(1, ORDER + 1), reversed(tables)):
        ones, twos = (n == 1).sum(), (n == 2).sum()
        d = min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones else 0.5
        ctx, at = np.unique(u >> U64(16), return_inverse=True)
        total = np.bincount(at, weights=n)
        kinds = np.bincount(at)
        weight = d * kinds / total
        if order == 1:
            lower = np.full(len(u), 1 / (len(u) + 1))           # the rest of the mass goes to letters never seen
        else:
            lower = np.exp(below_logp(u & _mask(order - 1)))
        p = np.maximum(n - d, 0) / total[at] + weight[at] * lower
        levels.append(Level(u, np.log(p), ctx, np.log(weight)))
        below_logp = functools.partial(log_probability, list(levels))
    return levels


def log_probability(levels: list[Level], key: np.ndarray) -> np.ndarray:
    """Log-probability of the last character of each key given the ones before it."""
    out, todo = np.zeros(len(key)), np.arange(len(key))
    for order in range(len(levels), 0, -1):
        level = levels[order - 1]
        k = key[todo] & _mask(order)
        at, hit = _find(level.grams, k)
        out[todo[hit]] += level.logp[at[hit]]
        todo, k = todo[~hit], k[~hit]
        at, known = _find(level.contexts, k >> U64(16))
        out[todo[known]] += level.backoff[at[known]]
    out[todo] -= np.log(len(levels[0].grams) + 1)
    return out


@dataclass
class Model:
    languages: list[str]
    levels: list[list[Level]]
    #: per language, from the calibration rows: mean cross-entropy of long texts, and its spread per character
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts by languages) and the number of letters and inner spaces."""
        k, offs = grams(texts)
        size = np.diff(offs)
        out = np.full((len(texts), len(self.languages)), np.nan)
        some = np.flatnonzero(size)
        if len(some) and self.languages:
            u, at = np.unique(k, return_inverse=True)
            for j, levels in enumerate(self.levels):
                x = -log_probability(levels, u)[at]
                out[some, j] = np.add.reduceat(x, offs[:-1][some]) / size[some]
        return out, size

    def limit(self, size: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Cross-entropy from which a text of that length is rejected: a quarter above the language's mean, plus six
        standard errors."""
        return 1.25 * self.mean[best] + 6 * self.spread[best] / np.sqrt(np.maximum(size, 1))

    def predict(self, texts: list[str | None]):
        return self.decide(*self.entropies(texts))

    def decide(self, h: np.ndarray, size: np.ndarray):
        """Language, score, cross-entropy and rejection from the cross-entropies (texts by languages)."""
        lang = np.full(len(h), "und", object)
        score, rejected = np.zeros(len(h)), np.ones(len(h), bool)
        entropy = np.full(len(h), np.nan)
        ok = np.flatnonzero(~np.isnan(h).any(1)) if self.languages else np.empty(0, np.int64)
        if len(ok):
            x = h[ok]
            best = x.argmin(1)
            entropy[ok] = x.min(1)
            lang[ok] = np.array(self.languages, object)[best]
            score[ok] = 1 / np.exp(-(x - x.min(1, keepdims=True)) * SHARPNESS).sum(1)
            rejected[ok] = entropy[ok] > self.limit(size[ok], best) if self.mean is not None else False
        return lang, score, entropy, rejected


def fit(training: DataFrame) -> Model:
    """Fit on (doc_id, lang, text); rows with null lang, text or doc_id are left out."""
    rows = training.where("lang is not null and text is not null and doc_id is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = written(rows.mapInArrow(_count, "lang string, gram long, n long")
                     .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    kinds = {r.lang: r["count"] for r in counts.groupBy("lang").count().collect()}     # a row per language
    languages = sorted(kinds)
    if sum(kinds.values()) > BROADCAST_GRAMS:
        model = tabled(counts, languages)
    else:
        top = _coded(counts, languages).orderBy("lang", "gram").toArrow()
        code, gram, n = (top.column(i).to_numpy() for i in range(3))
        model = Model(languages, [kneser_ney(gram[code == i].view(U64), n[code == i]) for i in range(len(languages))])
    if languages:
        calibrate(model, rows)
    return model


# ---- models too large for a task ------------------------------------------------------------------------

@dataclass
class Tables(Model):
    """A model held in written tables.  ``levels`` is empty; per order, a row per n-gram (or context) with a map from
    the language's place in ``languages`` to the log-probability (or the log back-off weight)."""
    grams: list[DataFrame] | None = None
    contexts: list[DataFrame] | None = None
    #: rows of grams and contexts, and per language the log-probability of a letter never seen
    sizes: list[tuple[int, int]] | None = None
    unseen: list[float] | None = None


def _codes(spark: SparkSession, languages: list[str]) -> DataFrame:
    """(code, lang) from Arrow: from Python rows they would be read by further Python workers, beside those of the batches."""
    return spark.createDataFrame(pa.table({"code": pa.array(range(len(languages)), pa.int32()),
                                           "lang": pa.array(languages, pa.string())}))


def _coded(df: DataFrame, languages: list[str]) -> DataFrame:
    """(lang, gram, n) with the language's place in ``languages`` for its name."""
    return df.join(F.broadcast(_codes(df.sparkSession, languages)), "lang").select(F.col("code").alias("lang"), "gram", "n")


def _low(key: str, n: int):
    """The last n characters of a key."""
    return F.col(key) if n == ORDER else F.col(key).bitwiseAND(F.lit((1 << (16 * n)) - 1))


def _before(key):
    """A key without its last character."""
    return F.shiftrightunsigned(key, 16)


def tabled(counts: DataFrame, languages: list[str]) -> Tables:
    """``kneser_ney`` of every language as Spark tables."""
    tables = [_coded(counts, languages).withColumn("n", F.col("n").cast("double"))]
    for order in range(ORDER - 1, 0, -1):                   # each order counts the distinct continuations
        lower = tables[0].select("lang", _low("gram", order).alias("gram")).groupBy("lang", "gram").agg(
            F.count("*").cast("double").alias("n"))
        tables.insert(0, written(lower, f"grams{order}"))
    by_key = lambda df, key, x: df.groupBy(key).agg(  # noqa: E731 (at most an entry per language)
        F.map_from_entries(F.collect_list(F.struct("lang", x))).alias(x))
    grams, contexts, sizes, unseen, below = [], [], [], [], None
    for order, t in enumerate(tables, 1):
        stats = t.groupBy("lang").agg(F.sum((F.col("n") == 1).cast("long")).alias("ones"),
                                      F.sum((F.col("n") == 2).cast("long")).alias("twos"), F.count("*").alias("all"))
        d = F.when(F.col("ones") > 0, F.least(F.greatest(F.col("ones") / (F.col("ones") + 2 * F.col("twos")),
                                                         F.lit(0.05)), F.lit(0.95))).otherwise(0.5)
        stats = written(stats.select("lang", d.alias("d"), "all"), "discounts")
        ctx = t.groupBy("lang", _before("gram").alias("ctx")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        ctx = written(ctx.join(F.broadcast(stats), "lang").select(
            "lang", "ctx", "total", "d", (F.col("d") * F.col("kinds") / F.col("total")).alias("weight"), "all"), "contexts")
        x = join_checked(t.withColumn("ctx", _before("gram")), ctx, ["lang", "ctx"])
        if order == 1:
            unseen = [-float(np.log(r["all"] + 1)) for r in stats.orderBy("lang").collect()]
            x = x.withColumn("lower", 1 / (F.col("all") + 1))       # the rest of the mass goes to letters never seen
        else:
            x = join_checked(x.withColumn("low", _low("gram", order - 1)), below, ["lang", "low"])
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("lower")
        x = written(x.select("lang", "gram", p.alias("p")), f"level{order}")
        below = x.select("lang", F.col("gram").alias("low"), F.col("p").alias("lower"))
        grams.append(written(by_key(x.withColumn("logp", F.log("p")), "gram", "logp"), f"model{order}"))
        contexts.append(written(by_key(ctx.withColumn("backoff", F.log("weight")), "ctx", "backoff"), f"backoff{order}"))
        sizes.append((grams[-1].count(), contexts[-1].count()))
    return Tables(languages, [], grams=grams, contexts=contexts, sizes=sizes, unseen=unseen)


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, gram, n): the distinct four-grams of each text."""
    forget()
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            k, offs = grams(part.column(1).to_pylist())
            row = np.repeat(np.arange(part.num_rows), np.diff(offs))
            order = np.lexsort((k, row))
            k, row = k[order], row[order]
            first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (row[1:] != row[:-1])]) if len(k) else order
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row[first])), pa.array(k[first].view(np.int64)),
                 pa.array(np.diff(np.r_[first, len(k)]))], ["row", "gram", "n"])


def measured(texts: DataFrame, model: Tables) -> DataFrame:
    """(row, h, size) of texts (row, text): cross-entropies per character by language; texts without a letter have none."""
    size = len(model.languages)
    own = written(texts.select("row", "text").mapInArrow(_grams_of, "row long, gram long, n long"), "textgrams")
    u = own.select("gram").distinct()
    for order in range(ORDER, 0, -1):
        n, m = (size * x for x in model.sizes[order - 1])
        level = model.grams[order - 1].select(F.col("gram").alias(f"g{order}"), F.col("logp").alias(f"p{order}"))
        context = model.contexts[order - 1].select(F.col("ctx").alias(f"c{order}"), F.col("backoff").alias(f"b{order}"))
        u = join_checked(u.withColumn(f"g{order}", _low("gram", order)), level, f"g{order}", "left", n)
        u = join_checked(u.withColumn(f"c{order}", _before(F.col(f"g{order}"))), context, f"c{order}", "left", m)

    def logp(i):
        out = F.lit(model.unseen[i])
        for order in range(1, ORDER + 1):
            out = F.coalesce(F.try_element_at(f"p{order}", F.lit(i)),
                             F.coalesce(F.try_element_at(f"b{order}", F.lit(i)), F.lit(0.0)) + out)
        return out
    u = written(u.select("gram", F.array(*[logp(i) for i in range(size)]).alias("logp")), "scored")
    found = join_checked(own, u, "gram", rows=size * u.count()).groupBy("row").agg(
        F.sum("n").alias("size"), *[F.sum(-F.col("n") * F.col("logp")[i]).alias(f"h{i}") for i in range(size)])
    return found.select("row", F.array(*[F.col(f"h{i}") / F.col("size") for i in range(size)]).alias("h"), "size")


def _numbered(df: DataFrame) -> DataFrame:
    return written(df.withColumn("row", F.monotonically_increasing_id()), "numbered")


def _identified(docs: DataFrame, model: Tables) -> DataFrame:
    """``identify`` by joins."""
    names = docs.columns
    plain = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(names)])
    columns = plain.columns
    rows = _numbered(plain)
    judge = Model(model.languages, [], model.mean, model.spread)        # what a task needs, without the tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.array([x or [np.nan] * len(judge.languages) for x in batch.column(len(columns)).to_pylist()], float)
            size = np.asarray(batch.column(len(columns) + 1).fill_null(0))
            lang, score, entropy, rejected = judge.decide(h.reshape(len(size), -1), size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(columns)], pa.array(lang.tolist(), pa.string()), pa.array(score),
                 pa.array(entropy), pa.array(rejected)], [*columns, "lang_pred", "lang_score", "entropy", "rejected"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    out = rows.join(measured(rows, model).hint("merge"), "row", "left").select(*columns, "h", "size").mapInArrow(
        run, f"{kinds}, lang_pred string, lang_score double, entropy double, rejected boolean")
    return out.toDF(*names, "lang_pred", "lang_score", "entropy", "rejected")


def calibrate(model: Model, rows: DataFrame) -> None:
    """Set the model's mean and spread from all training rows (lang, text)."""
    mean, spread = [], []
    found = _own_by_tables(rows, model) if isinstance(model, Tables) else _own(rows, model)
    stats = (found.where("size > 1 and not isnan(h)")
             .groupBy("lang").agg(F.avg("h").alias("mean"), F.avg(F.col("h") * F.col("h")).alias("square"),
                                  F.avg("size").alias("size"), F.max("h").alias("most")).collect())
    by = {r.lang: r for r in stats}
    for x in model.languages:
        r = by.get(x)
        mean.append(r.mean if r else np.inf)
        spread.append(np.sqrt(max(r.square - r.mean ** 2, 0.01) * max(r.size, 1)) if r else 0.0)
    model.mean, model.spread = np.array(mean), np.array(spread)


def _own_by_tables(rows: DataFrame, model: Tables) -> DataFrame:
    some = _numbered(rows)
    codes = _codes(some.sparkSession, model.languages)
    return some.select("row", "lang").join(F.broadcast(codes), "lang").join(measured(some, model), "row").select(
        "lang", F.get("h", F.col("code")).alias("h"), "size")


def _own(rows: DataFrame, model: Model) -> DataFrame:
    """(lang, h, size): each text's cross-entropy by its own language's model."""
    broadcast = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = {x: Model([x], [levels]) for x, levels in zip(broadcast.value.languages, broadcast.value.levels)}
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                langs = np.array(part.column(0).to_pylist(), object)
                texts = part.column(1).to_pylist()
                for lang in sorted(set(langs) & set(own)):          # texts without a letter have no model
                    h, size = own[lang].entropies([texts[i] for i in np.flatnonzero(langs == lang)])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(size), pa.string()), pa.array(h[:, 0]), pa.array(size)],
                                                     ["lang", "h", "size"])
    return rows.mapInArrow(run, "lang string, h double, size long")


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, lang_score, entropy and rejected; the other columns stay as they are."""
    clash = [c for c in docs.columns if c in ("lang_pred", "lang_score", "entropy", "rejected")]
    docs = docs.drop(*clash)
    if isinstance(model, Tables):
        return _identified(docs, model)
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                lang, score, entropy, rejected = broadcast.value.predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(entropy),
                     pa.array(rejected)], [*part.schema.names, "lang_pred", "lang_score", "entropy", "rejected"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kinds}, lang_pred string, lang_score double, entropy double, rejected boolean")


def in_training(doc_id="doc_id"):
    """The fixed split: crc32 of the id as text, modulo 5, is not 0 (null ids: neither)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) != 0
