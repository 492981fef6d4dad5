"""Perplexity of documents under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import rows, stored

ORDER = 4
BITS = 16
#: Most distinct n-grams sent to every task; beyond it each document's counts are joined by shuffle.
SENT_GRAMS = 4_000_000
QUANTILE = 0.999
SLACK = 1.1
#: Characters at the model's mean that every text is taken to have besides its own, so that short texts are not judged by chance.
PRIOR_CHARS = 50.0
_MASKS = [(1 << BITS * n) - 1 for n in range(ORDER + 1)]
_UNKNOWN = 0xFFFD


def grams(text: str | None) -> np.ndarray:
    """The ``ORDER`` last characters at each place of a text, as one number; before the start they are zero.

    White space counts as one space, digits as zero, and characters beyond 16 bits as one unknown character.
    """
    codes = np.frombuffer((" ".join(text.split()) if text else "").encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes > 0xFFFF, _UNKNOWN, np.where((codes >= 48) & (codes <= 57), 48, codes)).astype(np.uint64)
    padded = np.concatenate((np.zeros(ORDER - 1, np.uint64), codes))
    out = np.zeros(len(codes), np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(BITS)) | padded[i : i + len(codes)]
    return out


def counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n, n_trusted`` over the whole texts of ``lang, text, trusted``: how often, and how often in trusted text."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            for (lang, trusted), parts in held.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                for at in range(0, len(found), 100_000):
                    g, m = found[at : at + 100_000].view(np.int64), n[at : at + 100_000]
                    yield pa.record_batch([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(m), pa.array(m if trusted else np.zeros_like(m))], ["lang", "gram", "n", "n_trusted"])

        for langs, texts, marks in rows(batches, "lang", "text", "trusted"):
            for lang, text, trusted in zip(langs, texts, marks, strict=True):
                found = grams(text)
                held.setdefault((lang, bool(trusted)), []).append(found)
                size += len(found)
                if size > 8_000_000:
                    yield from emptied()
                    held, size = {}, 0
        yield from emptied()

    found = docs.select("lang", "text", "trusted").mapInArrow(counted, "lang string, gram bigint, n bigint, n_trusted bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("n_trusted").alias("n_trusted"))


def probabilities(counted: DataFrame) -> DataFrame:
    """``lang, gram, logp``: log-probability of the last character of every n-gram met, given the ones before it.

    The model of a language counts trusted text at the highest order, and below it
    the number of different characters before an n-gram. Three discounts per order
    come from how many n-grams occur one to four times; what they free goes to the
    next lower order, and at the lowest to an even spread over the characters met.
    Every order is one round of joins on (language, n-gram) and (language, context).
    """
    seen = counted.filter("n_trusted > 0").select("lang", "gram", F.col("n_trusted").alias("c"))
    by_order = {ORDER: stored(seen)}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit(_MASKS[order])).alias("gram")
        by_order[order] = stored(by_order[order + 1].select("lang", suffix).groupBy("lang", "gram").agg(F.count("*").alias("c")))
    wanted = counted.select("lang", "gram")
    symbols = wanted.select("lang", F.col("gram").bitwiseAND(F.lit(_MASKS[1])).alias("gram")).distinct().groupBy("lang").agg(F.count("*").alias("symbols"))
    lower: DataFrame | None = None
    for order in range(1, ORDER + 1):
        here = by_order[order]
        context = F.shiftrightunsigned("gram", BITS)
        kinds = here.groupBy("lang").agg(*[F.count_if(F.col("c") == k).cast("double").alias(f"t{k}") for k in range(1, 5)])
        y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))

        def discount(k: int) -> Column:
            raw = k - (k + 1) * y * F.try_divide(F.col(f"t{k + 1}"), F.col(f"t{k}"))
            # with no n-gram of such a count, or by chance out of range, half of the smallest count
            return F.least(F.greatest(F.coalesce(raw, F.lit(0.5)), F.lit(0.1)), F.lit(float(k)))

        discounts = kinds.select("lang", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])
        after = here.groupBy("lang", context.alias("context")).agg(
            F.sum("c").alias("total"), *[F.count_if(test).alias(f"m{k}") for k, test in ((1, F.col("c") == 1), (2, F.col("c") == 2), (3, F.col("c") >= 3))]
        )
        need = wanted.select("lang", F.col("gram").bitwiseAND(F.lit(_MASKS[order])).alias("gram")).distinct() if order < ORDER else wanted
        need = need.withColumn("context", context).withColumn("suffix", F.col("gram").bitwiseAND(F.lit(_MASKS[order - 1])))
        joined = need.join(here, ["lang", "gram"], "left").join(after, ["lang", "context"], "left").join(F.broadcast(discounts), "lang", "left")
        if lower is None:
            joined = joined.join(F.broadcast(symbols), "lang").withColumn("p_lower", 1 / F.col("symbols"))
        else:
            joined = joined.join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("p_lower")), ["lang", "suffix"])
        c = F.coalesce("c", F.lit(0))
        cut = F.when(c == 0, 0.0).when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        freed = (F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("total")
        p = F.when(F.col("total").isNull(), F.col("p_lower")).otherwise((c - cut) / F.col("total") + freed * F.col("p_lower"))
        lower = stored(joined.select("lang", "gram", p.alias("p")))
    return lower.select("lang", "gram", F.log("p").alias("logp"))


def score(docs: DataFrame, model: DataFrame, sent_grams: int = SENT_GRAMS) -> DataFrame:
    """``doc_id, lang, trusted, n_grams, log_likelihood`` of each row of ``doc_id, lang, text, trusted``.

    A model of up to ``sent_grams`` n-grams is sent to every task; a larger one is
    joined with each document's n-gram counts in a shuffle. Equal results.
    """
    model = stored(model)
    id_type = dict(docs.dtypes)["doc_id"]
    if model.count() <= sent_grams:
        table = model.toArrow()
        tables = {}
        langs, keys, values = table.column("lang").combine_chunks(), table.column("gram").to_numpy(), table.column("logp").to_numpy()
        codes = langs.dictionary_encode()
        for i, lang in enumerate(codes.dictionary.to_pylist()):
            at = np.flatnonzero(codes.indices.to_numpy() == i)
            order = np.argsort(keys[at])
            tables[lang] = keys[at][order], values[at][order]
        shared = docs.sparkSession.sparkContext.broadcast(tables)

        def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                n, total = [], []
                for lang, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    found, m = np.unique(grams(text).view(np.int64), return_counts=True)
                    n.append(int(m.sum()))
                    total.append(float(m @ known[lang][1][np.searchsorted(known[lang][0], found)]) if len(found) else 0.0)
                yield pa.record_batch([batch.column(0), batch.column(1), batch.column(3), pa.array(n, pa.int64()), pa.array(total, pa.float64())], ["doc_id", "lang", "trusted", "n_grams", "log_likelihood"])

        return docs.select("doc_id", "lang", "text", "trusted").mapInArrow(scored, f"doc_id {id_type}, lang string, trusted boolean, n_grams bigint, log_likelihood double")

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, m = np.unique(grams(row[2]).view(np.int64), return_counts=True)
                yield pa.record_batch([pa.array([row[0]] * len(m), batch.schema.field(0).type), pa.array([row[1]] * len(m), pa.string()), pa.array(found), pa.array(m)], ["row_id", "lang", "gram", "n"])

    numbered = stored(docs.select("doc_id", "lang", "text", "trusted").withColumn("row_id", F.monotonically_increasing_id()))
    sums = numbered.select("row_id", "lang", "text").mapInArrow(listed, "row_id bigint, lang string, gram bigint, n bigint").join(model, ["lang", "gram"])
    sums = sums.groupBy("row_id").agg(F.sum("n").alias("n_grams"), F.sum(F.col("n") * F.col("logp")).alias("log_likelihood"))
    return numbered.drop("text").join(sums, "row_id", "left").select("doc_id", "lang", "trusted", F.coalesce("n_grams", F.lit(0)).alias("n_grams"), F.coalesce("log_likelihood", F.lit(0.0)).alias("log_likelihood"))


def classify(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    quantile: float = QUANTILE, slack: float = SLACK, prior_chars: float = PRIOR_CHARS, sent_grams: int = SENT_GRAMS, sent_ids: int = 2_000_000,
) -> DataFrame:
    """``doc_id, lang, n_grams, perplexity, threshold, kept`` for every row of ``docs``.

    ``trusted`` holds the identifiers of trusted documents, whose whole texts train one
    model per language. Perplexity is per character, drawn to the mean of the
    language's trusted text by ``prior_chars`` characters. A document is kept if it
    does not exceed ``slack`` times the ``quantile`` of its language's trusted
    documents. Rows with a null language form a language of their own (``und``). Null
    or empty texts and documents of languages without trusted text have a null
    perplexity and are not kept. Rows with a null identifier are not trusted;
    repeated rows stay. Up to ``sent_ids`` trusted identifiers are broadcast, more
    are joined by shuffle.
    """
    ids = stored(trusted.select(F.col(trusted.columns[0]).alias("_trusted_id")).filter("_trusted_id is not null").distinct())
    known = F.broadcast(ids) if ids.count() <= sent_ids else ids
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    marked = source.join(known, source["doc_id"] == ids["_trusted_id"], "left").select("doc_id", "lang", "text", F.col("_trusted_id").isNotNull().alias("trusted"))
    scored = stored(score(marked, probabilities(stored(counts(marked))), sent_grams))
    mean = scored.filter("trusted and n_grams > 0").groupBy("lang").agg((F.sum("log_likelihood") / F.sum("n_grams")).alias("mean"))
    drawn = (F.col("log_likelihood") + prior_chars * F.col("mean")) / (F.col("n_grams") + prior_chars)
    judged = scored.join(F.broadcast(mean), "lang", "left").withColumn("perplexity", F.when(F.col("n_grams") > 0, F.exp(-drawn)))
    limits = judged.filter("trusted and perplexity is not null").groupBy("lang").agg((F.percentile_approx("perplexity", quantile, 10_000) * slack).alias("threshold"))
    out = judged.join(F.broadcast(limits), "lang", "left")
    return out.select("doc_id", "lang", "n_grams", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"))
