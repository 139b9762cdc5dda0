"""Column expressions for network-flow tables and detector results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade.functions.numeric import band, col

BENIGN = "BENIGN"

# Text looked for in the lower-cased label, in this order, and the
# family it stands for.
FAMILY_RULES = (
    ("benign", "Benign"),
    ("dos hulk", "DoS"),
    ("dos goldeneye", "DoS"),
    ("dos slowloris", "DoS"),
    ("dos slowhttptest", "DoS"),
    ("heartbleed", "DoS"),
    ("ddos", "DDoS"),
    ("portscan", "Probe / Scan"),
    ("ftp-patator", "Brute Force"),
    ("ssh-patator", "Brute Force"),
    ("bot", "Botnet"),
    ("infiltration", "Infiltration"),
    ("web attack", "Web Attack"),
)

# The coarser class groups.  "ddos" comes before "dos", otherwise
# every DDoS label would count as DoS.
GROUP_RULES = (
    ("ddos", "DDoS"),
    ("dos", "DoS"),
    ("heartbleed", "DoS"),
    ("slowhttptest", "DoS"),
    ("portscan", "PortScan"),
    ("patator", "Brute Force"),
    ("web attack", "Web Attack"),
    ("bot", "Botnet"),
    ("infiltration", "Infiltration"),
)

# Mean-error limits of the severity bands.
DRIFT_LIMITS = ((0.0234, "ELEVATED"), (0.0567, "HIGH"), (0.0891, "CRITICAL"))


def _first_rule(label: Column, rules: Sequence[tuple[str, str]]) -> Column:
    text = F.lower(label)
    result = F.lit("Other")
    for part, name in reversed(rules):
        result = F.when(F.contains(text, F.lit(part)), F.lit(name)).otherwise(result)
    return result


def clean_label(label: str | Column) -> Column:
    return F.trim(col(label))


def attack_family(label: str | Column) -> Column:
    return _first_rule(col(label), FAMILY_RULES)


def class_group(label: str | Column, ddos_first: bool = True) -> Column:
    """Class group; ``ddos_first=False`` lets "dos" win as in the original rules."""
    label = clean_label(label)
    rules = GROUP_RULES if ddos_first else (*GROUP_RULES[1:], GROUP_RULES[0])
    return F.when(label == BENIGN, F.lit(BENIGN)).otherwise(_first_rule(label, rules))


def is_benign(label: str | Column) -> Column:
    return col(label) == BENIGN


def binary_class(label: str | Column) -> Column:
    """B for benign and M for anything else."""
    return F.when(is_benign(label), F.lit("B")).otherwise(F.lit("M"))


def is_anomalous(error: str | Column, threshold: float | Column) -> Column:
    return col(error) >= threshold


def action_text(error: str | Column, threshold: float | Column, label: str | Column) -> Column:
    return F.when(
        is_anomalous(error, threshold), F.concat(F.lit("ATTACK: "), col(label))
    ).otherwise(F.lit("BENIGN - Passed"))


def drift_severity(mean: str | Column, limits: Sequence[tuple[float, str]] = DRIFT_LIMITS) -> Column:
    return band(mean, limits, "OK")


def micros_to_millis(value: str | Column) -> Column:
    return col(value) / F.lit(1000.0)
