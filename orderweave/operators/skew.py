"""Joins that stay even when one key holds a large share of the rows.

Two cases need care.  Many rows with a blank or heavy key on the *left* would
all meet in one task: they get a salt, and the matching right rows are repeated
once per salt.  A heavy key on the *right* is the mirror image: its rows get
the salt and the left row is repeated.  Every pair still meets exactly once, so
the result is the plain join's.  Which keys are heavy is the caller's knowledge;
blank ones need none.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import is_blank, is_empty

_SEPARATOR = "\u0001"


def key_text(columns: Sequence[str]) -> Column:
    """One text per key, NULL where any part is NULL."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    parts = [F.col(c).cast("string") for c in columns]
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(_SEPARATOR), part]
    return F.concat(*pieces)


def _one_of(key: Column, values: Sequence[str]) -> Column:
    return F.coalesce(key.isin(list(values)), F.lit(False)) if values else F.lit(False)


def _row_salt(columns: Sequence[str], salts: int) -> Column:
    """Salt from the row's own values: a recomputed task gives the same one."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def _with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a column that the optimizer keeps as computed here.

    As a plain projection the hash of a whole row would be copied into every
    place that uses it, and into constraints over all equal keys, which takes
    minutes to plan in a long chain.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _repeated(condition: Column, salts: int) -> Column:
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return F.explode(F.when(condition, every).otherwise(F.array(F.lit(0))))


def key_condition(on: Sequence[tuple[str, str]], only_if: str | None = None) -> Column:
    terms = [f"{l} = {r}" for l, r in on]
    return F.expr(" and ".join(terms + [f"({only_if})"] if only_if else terms))


def _spread_condition(left: DataFrame, on: Sequence[tuple[str, str]], only_if: str | None, salt_by: Sequence[str]) -> Column:
    """The key condition with a text of the row's own in place of a NULL first key.

    Rows that match nothing then do not meet in one task, even where the right side is
    dealt by its first key alone. That the text occurs as a key changes nothing: a NULL
    key never matches.
    """
    first, key = on[0]
    by = [c for c in salt_by if c in left.columns] or left.columns
    own = F.concat(F.lit(_SEPARATOR), F.xxhash64(*by).cast("string")).cast(left.schema[first].dataType)
    terms = (F.coalesce(F.col(first), own) == F.col(key)) & F.col(first).isNotNull()
    return terms & key_condition(on[1:], only_if) if on[1:] or only_if else terms


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    *,
    only_if: str | None = None,
    spread_blank: bool = False,
    spread_keys: Sequence[str | None] = (),
    heavy_left: Sequence[str] = (),
    heavy_right: Sequence[str] = (),
    spread_nulls: bool = False,
    salts: int = 64,
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """`left.join(right, on, how)` for `left`, `inner` and `left_semi` joins.

    `only_if` is a condition on the left row without which it matches nothing.
    `spread_blank` salts left rows whose first key is blank or NULL, `spread_keys`
    those whose first key is one of these (None: is NULL).  `spread_nulls`: the first
    key, a text, is NULL where an earlier left join found nothing.  Left rows are salted by those of the `salt_by` columns they have, or by all columns.
    Column names must be distinct across both sides.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    if how == "left_semi":
        right = right.select([r for _, r in on]).distinct()
        heavy_right = ()
    left_columns, right_columns = left.columns, right.columns
    if not (spread_blank or spread_keys or heavy_left or heavy_right):
        if spread_nulls and how == "left":
            return left.join(right, _spread_condition(left, on, only_if, salt_by), how)
        return left.join(right, key_condition(on, only_if), how)

    left_key, right_key = (key_text(side) for side in zip(*on))
    if heavy_left and heavy_right:
        salts = max(2, math.isqrt(salts))
    pairs = list(on)

    if spread_blank or spread_keys or heavy_left:
        divided = _one_of(left_key, heavy_left)
        repeated = _one_of(right_key, heavy_left)
        if spread_blank:
            divided = divided | is_blank(F.col(on[0][0]))
            repeated = repeated | F.coalesce(is_empty(F.col(on[0][1])), F.lit(False))
        if spread_keys:
            known = [k for k in spread_keys if k is not None]
            divided = divided | _one_of(F.col(on[0][0]), known)
            repeated = repeated | _one_of(F.col(on[0][1]), known)
            if len(known) < len(spread_keys) or spread_nulls:
                divided = divided | F.col(on[0][0]).isNull()
        # Kept on the left side: a second join on the same key finds the rows in place.
        salt = f"_salt_{on[0][0]}" if not heavy_left else "_salt"
        if salt not in left_columns:
            by = [c for c in salt_by if c in left_columns] or left_columns
            salted = F.when(divided, _row_salt(by, salts)).otherwise(0)
            left = _with_computed(left, salt, salted)
        right = right.select("*", _repeated(repeated, salts).alias("_right_salt"))
        pairs.append((salt, "_right_salt"))
        if spread_blank or spread_keys:
            # dealt by the salt too: the left side follows a right one that is dealt by the key alone
            right = right.repartition(*[r for _, r in pairs])

    if heavy_right:
        present = right.where(_one_of(right_key, heavy_right)).select(right_key.alias("_heavy"))
        # At most len(heavy_right) rows.
        matches = left_key == F.col("_heavy")
        if only_if:
            matches = matches & F.expr(only_if)
        left = left.join(F.broadcast(present.distinct()), matches, "left")
        left = left.select("*", _repeated(F.col("_heavy").isNotNull(), salts).alias("_part"))
        part = F.when(_one_of(right_key, heavy_right), _row_salt(right_columns, salts)).otherwise(0)
        right = _with_computed(right, "_right_part", part)
        pairs.append(("_part", "_right_part"))

    joined = left.join(right, key_condition(pairs, only_if), how)
    if heavy_right and how == "left":
        # A repeated left row misses in the parts that hold no match for it; its key
        # is known to be present, so those misses are not the join's.
        joined = joined.where(F.col("_heavy").isNull() | F.col("_right_part").isNotNull())
    kept = [c for c in joined.columns if c in left_columns or c in right_columns]
    kept += [c for c in joined.columns if c.startswith("_salt_") and c not in kept]
    if how == "left_semi":
        kept = [c for c in kept if c in left_columns or c.startswith("_salt_")]
    return joined.select(kept)
