"""Classification helpers: status taxonomy, banding and two-way labels."""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortcraft.functions.parse import ColumnOrName, _col

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# Status taxonomy (status text -> group, outcome flag).
RESOLVED_PAID = (
    "Fully Paid",
    "Does not meet the credit policy. Status:Fully Paid",
)
RESOLVED_DEFAULT = (
    "Charged Off",
    "Default",
    "Does not meet the credit policy. Status:Charged Off",
)
ACTIVE_CURRENT = ("Current",)
ACTIVE_DELINQUENT = (
    "Late (16-30 days)",
    "Late (31-120 days)",
    "In Grace Period",
)
# Band edges and labels (value exactly on an edge goes to the upper band).
INCOME_EDGES = (40000, 60000, 80000, 120000)
INCOME_LABELS = ("< $40k", "$40k–$60k", "$60k–$80k", "$80k–$120k", "$120k+")
DTI_EDGES = (10, 20, 30)
DTI_LABELS = ("< 10", "10–20", "20–30", "30+")
AMOUNT_EDGES = (5000, 10000, 20000, 30000)
AMOUNT_LABELS = ("< $5k", "$5k–$10k", "$10k–$20k", "$20k–$30k", "$30k+")
UNKNOWN_LABEL = "Unknown"
LOW_GRADES = ("D", "E")
MID_GRADES = ("B", "C")
GRADE_DOMAIN = ("A", "B", "C", "D", "E", "F", "G")
# ---------------------------------------------------------------------------


# The groups that a status can fall into.
STATUS_GROUPS = ("resolved_paid", "resolved_default", "active_current", "active_delinquent", "unknown")


@dataclass(frozen=True)
class StatusTaxonomy:
    """Ordered status classes; the first match wins, anything else is unknown."""

    paid: tuple[str, ...] = RESOLVED_PAID
    default: tuple[str, ...] = RESOLVED_DEFAULT
    current: tuple[str, ...] = ACTIVE_CURRENT
    delinquent: tuple[str, ...] = ACTIVE_DELINQUENT

    @property
    def resolved(self) -> tuple[str, ...]:
        return self.paid + self.default

    def group(self, status: ColumnOrName) -> Column:
        s = _col(status)
        return (
            F.when(s.isin(*self.paid), "resolved_paid")
            .when(s.isin(*self.default), "resolved_default")
            .when(s.isin(*self.current), "active_current")
            .when(s.isin(*self.delinquent), "active_delinquent")
            .otherwise("unknown")
        )

    def default_flag(self, status: ColumnOrName) -> Column:
        """1 defaulted, 0 paid, NULL when no final outcome is known."""
        s = _col(status)
        return F.when(s.isin(*self.default), F.lit(1)).when(s.isin(*self.paid), F.lit(0))

    def is_resolved(self, status: ColumnOrName) -> Column:
        return _col(status).isin(*self.resolved)

    def is_current(self, status: ColumnOrName) -> Column:
        return _col(status).isin(*self.current)

    def is_delinquent(self, status: ColumnOrName) -> Column:
        return _col(status).isin(*self.delinquent)

    def columns(self, status: ColumnOrName) -> dict[str, Column]:
        return {
            "status_group": self.group(status),
            "default_flag": self.default_flag(status),
            "is_resolved": self.is_resolved(status),
            "is_current": self.is_current(status),
            "is_delinquent": self.is_delinquent(status),
        }


TAXONOMY = StatusTaxonomy()


def band(
    c: ColumnOrName,
    edges: tuple[float, ...],
    labels: tuple[str, ...],
    null_label: str | None = UNKNOWN_LABEL,
) -> Column:
    """Half-open bands ``[e_i, e_i+1)`` from sorted edges.

    With ``null_label=None`` a NULL value fails every comparison and falls
    into the top band (the amount band behaves this way).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have one more entry than edges")
    value = _col(c)
    chain = F.when(value.isNull(), F.lit(null_label)) if null_label is not None else None
    for edge, label in zip(edges, labels):
        cond = value < F.lit(edge)
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def income_band(c: ColumnOrName) -> Column:
    return band(c, INCOME_EDGES, INCOME_LABELS)


def dti_band(c: ColumnOrName) -> Column:
    return band(c, DTI_EDGES, DTI_LABELS)


def amount_band(c: ColumnOrName) -> Column:
    return band(c, AMOUNT_EDGES, AMOUNT_LABELS, null_label=None)


def in_set_or_false(c: ColumnOrName, values: tuple[str, ...]) -> Column:
    """Membership where NULL reads as FALSE (``CASE WHEN x IN (..) THEN TRUE ELSE FALSE``)."""
    return F.coalesce(_col(c).isin(*values), F.lit(False))


def two_way(cond: Column, true_label: str, false_label: str) -> Column:
    """Label by a predicate; NULL predicate takes the false label."""
    return F.when(cond, F.lit(true_label)).otherwise(F.lit(false_label))


def period_label(year: ColumnOrName, early_year: int = 2014, early: str = "2014", late: str = "2015") -> Column:
    """Two-period label: the early year, everything else (NULL too) is late."""
    return F.when(_col(year) == early_year, F.lit(early)).otherwise(F.lit(late))
