"""The match rules, as data.

A rule says which report may explain an increment: same unit, same code or
same class, and a month of the increment that equals a month of the report
(``lag`` months later).  Rules are tried in list order; the first whose
keep-first report has a team wins.
"""

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Rule:
    id: str
    by: str  # "code" or "class"
    inc_month: str  # "exec" or "baixa"
    rep_month: str  # "exec" or "baixa"
    lag: int = 0
    open_only: bool = False  # only reports without a closing date
    null_safe: bool = False  # a missing class equals a missing class

    def __post_init__(self):
        if self.by not in ("code", "class"):
            raise ValueError(f"by must be 'code' or 'class', not {self.by!r}")
        for month in (self.inc_month, self.rep_month):
            if month not in ("exec", "baixa"):
                raise ValueError(f"month must be 'exec' or 'baixa', not {month!r}")


WATERFALL = (
    Rule("R1", "code", "exec", "exec"),
    Rule("R2", "code", "baixa", "baixa"),
    Rule("R3", "class", "baixa", "baixa"),
    Rule("R4", "code", "baixa", "exec", open_only=True),
    Rule("R4", "code", "baixa", "exec", lag=1, open_only=True),
    Rule("R5", "class", "baixa", "exec", open_only=True),
    Rule("R5", "class", "baixa", "exec", lag=1, open_only=True),
    Rule("R4-1", "code", "baixa", "exec", lag=1),
    Rule("R5-1", "class", "baixa", "exec", lag=1),
)


def null_safe(rules=WATERFALL) -> tuple[Rule, ...]:
    """The same rules with missing classes equal to each other."""
    return tuple(replace(r, null_safe=True) if r.by == "class" else r for r in rules)
