"""Many exact conditional distinct counts in one pass.

``count(DISTINCT CASE WHEN p THEN id END)`` written forty-odd times makes Spark
copy every row once per distinct expression.  Here each row carries one bit per
condition; rows are merged per id with ``bit_or`` (with a map-side combine, so a
hot id costs no more than any other) and the bits are summed per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 62  # conditions per bigint

# id column -> {output column: condition, or None for "any row"}
CountSpec = Mapping[str, Mapping[str, Column | None]]


def _words(conditions: Sequence[Column | None]) -> list[Column]:
    """Conditions packed into bigint columns, ``BITS`` to a word."""
    words = []
    for at in range(0, len(conditions), BITS):
        word = F.lit(0).cast("bigint")
        for i, cond in enumerate(conditions[at : at + BITS]):
            bit = F.lit(1 << i).cast("bigint")
            word = word.bitwiseOR(
                bit if cond is None else F.when(cond, bit).otherwise(F.lit(0).cast("bigint"))
            )
        words.append(word)
    return words


def distinct_counts(
    df: DataFrame,
    keys: Sequence[str],
    spec: CountSpec,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exact distinct counts of several id columns under several conditions.

    One row per ``keys`` group of ``df``.  NULL ids are not counted, but a group
    whose ids are all NULL still gives a row of zeros.

    ``sums`` are values to add up in the same pass: each row's ride along with its first
    id, are added per id where the bits are merged and per group where they are counted.
    They widen the rows that are shuffled, so this pays for few sums and ids with many rows.
    """
    sums = dict(sums or {})
    types = {f.name: f.dataType for f in df.select(*(F.sum(v).alias(n) for n, v in sums.items())).schema}
    packed = {col: _words(list(conds.values())) for col, conds in spec.items()}
    width = max(len(w) for w in packed.values())
    zero = F.lit(0).cast("bigint")
    names = [f"_w{i}" for i in range(width)]
    text_ids = any(df.schema[col].dataType.typeName() == "string" for col in spec)
    id_type = "string" if text_ids else "bigint"

    # conditions are evaluated in a projection of their own, where parts they have in
    # common are computed once; the rows are only unfolded per id column after that
    wide = df.select(
        *keys,
        *(F.col(col).cast(id_type).alias(f"_id{k}") for k, col in enumerate(packed)),
        *(
            word.alias(f"_w{k}_{i}")
            for k, words in enumerate(packed.values())
            for i, word in enumerate(words)
        ),
        *(v.alias(f"_sum_{n}") for n, v in sums.items()),
    )
    kinds = {f.name: f.dataType for f in wide.schema}
    entries = [
        F.struct(
            F.lit(k).alias("_kind"),
            F.col(f"_id{k}").alias("_id"),
            *(
                (F.col(f"_w{k}_{i}") if i < len(words) else zero).alias(names[i])
                for i in range(width)
            ),
            *(
                (F.col(f"_sum_{n}") if k == 0 else F.lit(None).cast(kinds[f"_sum_{n}"])).alias(f"_sum_{n}")
                for n in sums
            ),
        )
        for k, words in enumerate(packed.values())
    ]
    rows = wide.select(*keys, F.inline(F.array(*entries)))

    per_id = rows.groupBy(*keys, "_kind", "_id").agg(
        *(F.bit_or(n).alias(n) for n in names), *(F.sum(f"_sum_{n}").alias(f"_sum_{n}") for n in sums)
    )

    totals = []
    for kind, (_, conds) in enumerate(spec.items()):
        for i, out in enumerate(conds):
            word, bit = divmod(i, BITS)
            hit = (
                (F.col("_kind") == kind)
                & F.col("_id").isNotNull()
                & (F.col(names[word]).bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0)
            )
            totals.append(F.count(F.when(hit, F.lit(1))).alias(out))
    added = [F.sum(f"_sum_{n}").cast(types[n]).alias(n) for n in sums]
    return per_id.groupBy(*keys).agg(*totals, *added)


def distinct_pivot(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    buckets: Mapping[str, Column],
    flags: Mapping[str, Column | None],
    overall: bool = True,
) -> DataFrame:
    """Distinct ids per bucket and flag, as columns ``<flag>_<bucket>``.

    An id seen in two buckets counts in both columns but once in ``<flag>``.
    """
    conds: dict[str, Column | None] = {}
    for flag, cond in flags.items():
        if overall:
            conds[flag] = cond
        for bucket, inside in buckets.items():
            conds[f"{flag}_{bucket}"] = inside if cond is None else inside & cond
    return distinct_counts(df, keys, {id_col: conds})
