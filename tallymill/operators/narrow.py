"""Small numbers side by side while wide rows are shuffled.

A shuffled row spends eight bytes on each number, of which a month's value fills one or
two.  So four numbers go in one, those that are missing too; a row with a number of more
than BITS bits takes all of its numbers along as they are.  Nothing depends on how many
such rows there are.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymill.schema import MONTHS

BITS = 16
_EACH = 64 // BITS
_ZERO = 1 << (BITS - 1)  # stands for 0, as 0 stands for a missing number
_AS_THEY_ARE = "_as_they_are"


def _pack(at: int) -> str:
    return f"_side_by_side{at}"


def _fits(name: str) -> str:
    return f"`{name}` BETWEEN {1 - _ZERO} AND {_ZERO - 1}"


def _narrowed(rows: DataFrame, names: Sequence[str]) -> list[str]:
    return [f.name for f in rows.schema if f.name in names and f.dataType == T.LongType()]


def narrowed(rows: DataFrame, names: Sequence[str] = MONTHS) -> DataFrame:
    """``rows`` with the whole numbers among ``names`` put side by side."""
    found = _narrowed(rows, names)
    if not found:
        return rows
    kept = [f"`{c}`" for c in rows.columns if c not in found]
    packs = []
    for at in range(0, len(found), _EACH):
        some = [
            f"shiftleft(if({_fits(c)}, `{c}` + {_ZERO}, 0L), {BITS * i})"
            for i, c in enumerate(found[at : at + _EACH])
        ]
        packs.append(f"{' | '.join(some)} AS {_pack(at // _EACH)}")
    all_fit = " AND ".join(f"(`{c}` IS NULL OR {_fits(c)})" for c in found)
    values = ", ".join(f"`{c}`" for c in found)
    return rows.selectExpr(*kept, *packs, f"if({all_fit}, null, array({values})) AS {_AS_THEY_ARE}")


def widened(rows: DataFrame, like: DataFrame, names: Sequence[str] = MONTHS) -> DataFrame:
    """``narrowed`` rows with the columns of ``like`` as they were, and any others after
    them."""
    found = _narrowed(like, names)
    if not found:
        return rows
    value = {}
    for i, name in enumerate(found):
        number = f"shiftrightunsigned({_pack(i // _EACH)}, {BITS * (i % _EACH)}) & {(1 << BITS) - 1}"
        value[name] = (
            f"if({_AS_THEY_ARE} IS NULL, nullif({number}, 0L) - {_ZERO}, {_AS_THEY_ARE}[{i}]) AS `{name}`"
        )
    own = {_AS_THEY_ARE, *(_pack(at) for at in range(len(found)))}
    others = [f"`{c}`" for c in rows.columns if c not in own and c not in like.columns]
    return rows.selectExpr(*[value.get(c, f"`{c}`") for c in like.columns], *others)
