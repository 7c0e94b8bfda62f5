"""The licence policy, defined once for discovery, recovery and export."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions import let
from sievewright.functions.verdicts import add_reason, drop_reason
from sievewright.schema import UNKNOWN_LICENSE

# Fixed values of the policy, in the order in which a denial is explained.
ALLOWED_MARKERS = ("cc0", "cc by", "cc-by", "ccby", "public domain", "publicdomain", "dominio público", "pd-", "no restrictions")
DENIED_CLAUSES = ("-nc", " nc", "noncommercial", "non-commercial", "-nd", " nd", "noderiv", "no deriv", "fair use", "all rights reserved", "copyright")
UNIDENTIFIED, DENIED, UNRECOGNISED, ADMITTED = "sin licencia identificada", "cláusula no admitida ({})", "licencia no reconocida como libre", "admitida"


def unidentified(license_: Column) -> Column:
    return F.coalesce(license_, F.lit("")).isin("", UNKNOWN_LICENSE)


def normalised(license_: Column) -> Column:
    return F.regexp_replace(F.lower(license_), r"(?U)^\s+|\s+$", "")


def _any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(p)) for p in parts])


def is_allowed(license_: Column) -> Column:
    """Never null: denied clauses come before allowed markers, and no licence is no permission."""
    return F.when(unidentified(license_), False).otherwise(let(normalised(license_), lambda t: ~_any(t, DENIED_CLAUSES) & _any(t, ALLOWED_MARKERS)))


def explain(license_: Column) -> Column:
    """Why a licence is admitted or not: its first denied clause in the policy's order, if any."""

    def reason(text: Column) -> Column:
        out = F.when(F.lit(False), "")
        for clause in DENIED_CLAUSES:
            out = out.when(F.contains(text, F.lit(clause)), DENIED.format(clause.strip()))
        return out.when(_any(text, ALLOWED_MARKERS), ADMITTED).otherwise(UNRECOGNISED)

    return F.when(unidentified(license_), UNIDENTIFIED).otherwise(let(normalised(license_), reason))


def apply_policy(license_: Column, reasons: Column) -> Column:
    """The reasons with ``license_denied`` added or lifted; idempotent, and reversed by a better licence."""
    return F.when(is_allowed(license_), drop_reason(reasons, "license_denied")).otherwise(add_reason(reasons, "license_denied"))
