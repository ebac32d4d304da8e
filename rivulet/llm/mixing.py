"""Mixing sources to target weights by temperature, in built-in DataFrame functions only.

A source with token share p gets weight p^a / sum p^a. The exponent a in [0, 1]
is found by bisection so that no source repeats more than ``max_epochs`` times,
or so that the weights' entropy meets ``target_entropy`` (nats). Without a
``budget`` the mixture is as large as it must be for every source to be used
whole at least once, so no document is lost. Each source's budget (weight x
mixture tokens) is realised in epochs: whole permutations of its documents,
then the start of one more permutation up to the budget (the document that
crosses the budget still belongs to it). The stream of every source is cut into
the same number of blocks at equal token fractions, so each block holds the
weights; inside a block documents are permuted.

Prefix sums are two-level (hash bucket totals, then sums inside a bucket), so a
source with a third of all rows is no single task. The driver sees 15 candidate
exponents' sums a round, never a row.

Defined cases: a null source is a source of its own; a document counts its
white-space separated words, one at least (so null and empty texts count 1);
repeated rows are mixed as separate rows; an empty table gives an empty result;
extra columns are kept by ``mix_documents`` (names starting with ``_mix_`` are
reserved).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.common import materialize, null_as_empty

MAX_EPOCHS = 2.0
BLOCK_TOKENS = 1_000_000
BUCKET_BITS = 12
SEED = 17


def n_words(text: Column) -> Column:
    """White-space separated words, one at least."""
    t = F.trim(F.regexp_replace(null_as_empty(text), "[ \\t\\n\\x0B\\f\\r]+", " "))
    return F.greatest(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1, F.lit(1)).cast("long")


def _source_key(source: str) -> Column:
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def _order(epoch: Column, *keys: Column) -> Column:
    """Place of a row in its epoch's permutation."""
    return F.xxhash64(F.lit(SEED), epoch.cast("int"), *keys)


def solve_exponent(sources: DataFrame, max_epochs: float | None = MAX_EPOCHS, target_entropy: float | None = None,
                   budget: int | None = None, rounds: int = 10) -> dict:
    """Bisect the exponent over a table (``_mix_src``, ``_mix_tokens``) of one row a source.

    Each round is one aggregation that evaluates 15 exponents, four halvings.
    Returns alpha, z (sum p^alpha), total, budget.
    """
    total = sources.agg(F.sum("_mix_tokens")).first()[0]
    if not total:
        return {"alpha": 1.0, "z": 1.0, "total": 0, "budget": 0}
    p = F.col("_mix_tokens") / F.lit(float(total))

    def measure(alphas):
        aggs = []
        for i, a in enumerate(alphas):
            w = F.pow(p, F.lit(a))
            aggs += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log(p)).alias(f"l{i}"),
                     F.max(w / p).alias(f"hi{i}"), F.min(w / p).alias(f"lo{i}")]
        r = sources.agg(*aggs).first()
        out = []
        for i, a in enumerate(alphas):
            z = r[f"z{i}"]
            size = float(budget) if budget else total * z / r[f"lo{i}"]
            out.append({"alpha": a, "z": z, "entropy": math.log(z) - a * r[f"l{i}"] / z, "total": total, "budget": size,
                        "epochs": size / total * r[f"hi{i}"] / z})
        return out

    def enough(m):  # true from some exponent on: larger exponents repeat less and have less entropy
        if target_entropy is not None:
            return m["entropy"] <= target_entropy + 1e-12
        return m["epochs"] <= max_epochs + 1e-9

    flat, natural = measure([0.0, 1.0])
    if enough(flat):
        return flat
    if not enough(natural):
        raise ValueError(f"no exponent in [0, 1] meets the target (entropy {natural['entropy']:.4f}, "
                         f"epochs {natural['epochs']:.3f} at exponent 1)")
    lo, best = 0.0, natural
    for _ in range(rounds):
        step = (best["alpha"] - lo) / 16
        tried = measure([lo + step * k for k in range(1, 16)])
        first = next((k for k, m in enumerate(tried) if enough(m)), None)
        lo = tried[14]["alpha"] if first is None else (tried[first - 1]["alpha"] if first else lo)
        best = best if first is None else tried[first]
    return best


def plan_mixture(docs: DataFrame, source: str = "source", text: str = "text", ids: tuple[str, ...] = ("doc_id",), **target):
    """(solution, rows, plan): rows of (ids, _mix_src, _mix_tokens); plan has each source's weight, epochs and cut."""
    rows = materialize(docs.select(*ids, _source_key(source).alias("_mix_src"), F.col(source).alias("_mix_name"),
                                   n_words(F.col(text)).alias("_mix_tokens")), "mixing")
    sources = materialize(rows.groupBy("_mix_src").agg(F.sum("_mix_tokens").alias("_mix_tokens")), "sources")
    s = solve_exponent(sources, **target)
    total = float(s["total"] or 1)
    weight = F.pow(F.col("_mix_tokens") / total, F.lit(s["alpha"])) / F.lit(s["z"])
    epochs = weight * F.lit(float(s["budget"])) / F.col("_mix_tokens")
    plan = sources.select("_mix_src", F.col("_mix_tokens").alias("_mix_total"), weight.alias("_mix_weight"),
                          (weight * F.lit(float(s["budget"]))).alias("_mix_budget"),
                          F.floor(epochs + 1e-6).cast("int").alias("_mix_full"))
    plan = plan.withColumn("_mix_rest", F.col("_mix_budget") - F.col("_mix_full") * F.col("_mix_total"))
    # the permutation place at which each source's partial epoch ends: bucket totals first, then inside one bucket
    h = _order(F.col("_mix_full"), *[F.col(c) for c in ids])
    part = rows.join(plan.where("_mix_rest > 1e-3 * _mix_total / greatest(_mix_total, 1000)"), "_mix_src").select(
        "_mix_src", "_mix_tokens", "_mix_rest", h.alias("_mix_h"), F.shiftright(h, 64 - BUCKET_BITS).alias("_mix_b"))
    sums = part.groupBy("_mix_src", "_mix_b").agg(F.sum("_mix_tokens").alias("t"), F.first("_mix_rest").alias("rest"))
    before = F.coalesce(F.sum("t").over(Window.partitionBy("_mix_src").orderBy("_mix_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    crossing = (sums.withColumn("_mix_before", before).where("_mix_before < rest and _mix_before + t >= rest")
                .select("_mix_src", "_mix_b", "_mix_before"))
    run = F.coalesce(F.sum("_mix_tokens").over(Window.partitionBy("_mix_src").orderBy("_mix_h").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = (part.join(crossing, ["_mix_src", "_mix_b"]).withColumn("_mix_run", F.col("_mix_before") + run)
           .where("_mix_run < _mix_rest").groupBy("_mix_src").agg(F.max("_mix_h").alias("_mix_cut")))
    plan = materialize(plan.join(cut, "_mix_src", "left"), "mixplan")
    return s, rows, plan


def _repeat(rows: DataFrame, plan: DataFrame, ids) -> DataFrame:
    """One row per document and epoch."""
    out = rows.join(plan, "_mix_src")
    h = _order(F.col("_mix_full"), *[F.col(c) for c in ids])
    n = F.col("_mix_full") + F.when(h <= F.col("_mix_cut"), 1).otherwise(0)
    return out.withColumn("_mix_n", n).where("_mix_n > 0").withColumn(
        "_mix_epoch", F.explode(F.sequence(F.lit(0), F.col("_mix_n") - 1)))


def mixture(docs: DataFrame, source: str = "source", text: str = "text", block_tokens: int = BLOCK_TOKENS, **target) -> DataFrame:
    """The mixture as (doc_id, source, epoch, block, slot, tokens, weight): blocks are permutations that hold the weights."""
    ids = ("doc_id",)
    s, rows, plan = plan_mixture(docs, source, text, ids, **target)
    blocks = max(1, round(s["budget"] / block_tokens))
    e = _repeat(rows, plan, ids)
    h = _order(F.col("_mix_epoch"), *[F.col(c) for c in ids])
    e = e.withColumns({"_mix_h": h, "_mix_b": F.shiftright(h, 64 - BUCKET_BITS)})
    key = ["_mix_src", "_mix_epoch"]
    sums = e.groupBy(*key, "_mix_b").agg(F.sum("_mix_tokens").alias("t"))
    before = F.coalesce(F.sum("t").over(Window.partitionBy(*key).orderBy("_mix_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*key, "_mix_b", before.alias("_mix_before"))
    inside = Window.partitionBy(*key, "_mix_b").orderBy("_mix_h", "doc_id", "_mix_tokens").rowsBetween(Window.unboundedPreceding, -1)
    e = e.join(sums, [*key, "_mix_b"]).withColumn("_mix_run", F.col("_mix_before") + F.coalesce(F.sum("_mix_tokens").over(inside), F.lit(0)))
    place = (F.col("_mix_epoch") * F.col("_mix_total") + F.col("_mix_run")) / F.col("_mix_budget")
    e = e.withColumn("block", F.least(F.floor(place * blocks), F.lit(blocks - 1)).cast("long"))
    shuffled = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(SEED + 1), "doc_id", "_mix_epoch"), "doc_id", "_mix_epoch", "_mix_tokens")
    return e.select("doc_id", F.col("_mix_name").alias("source"), F.col("_mix_epoch").alias("epoch"), "block",
                    (F.row_number().over(shuffled) - 1).cast("long").alias("slot"), F.col("_mix_tokens").alias("tokens"),
                    F.col("_mix_weight").alias("weight"))


def mix_documents(docs: DataFrame, source: str = "source", text: str = "text", **target) -> DataFrame:
    """``docs`` with each row as often as its source's epochs ask for; the texts do not move."""
    _, _, plan = plan_mixture(docs, source, text, ("doc_id",), **target)
    keyed = docs.withColumn("_mix_src", _source_key(source))
    return _repeat(keyed, plan, ("doc_id",)).select(*docs.columns)
