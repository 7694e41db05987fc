"""Partition keys of a record: division from the lineage, review status from the entry type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REVIEWED_TYPE, UNREVIEWED_TYPE = "UniProtKB reviewed (Swiss-Prot)", "UniProtKB unreviewed (TrEMBL)"
KINGDOMS = {"Bacteria": "bacteria", "Archaea": "archaea", "Viruses": "viruses"}
PLANT_CLADES = ("Viridiplantae", "Rhodophyta", "Stramenopiles")
EXTRA_PLANT_CLADES = ("Euglyphida", "Euglenida")


def review_status(entry_type: Column) -> Column:
    """'reviewed' for curated entries, else 'unreviewed', null included (PRJ-08, FLT-04)."""
    return F.when(entry_type.like("%Swiss-Prot%"), "reviewed").otherwise("unreviewed")


def is_reviewed(entry_type: Column) -> Column:
    """The older, exact test (FLT-08)."""
    return entry_type == F.lit(REVIEWED_TYPE)


def entry_code(entry_type: Column) -> Column:
    """'sp' and 'tr' for the two known types, others as they are (PRJ-09)."""
    return F.when(entry_type == REVIEWED_TYPE, "sp").when(entry_type == UNREVIEWED_TYPE, "tr").otherwise(entry_type)


def tax_division(lineage: Column) -> Column:
    """One of eleven divisions; the first rule that holds wins, null and empty lineages are 'unclassified' (CLS-01)."""
    at = lambda i: F.get(lineage, F.lit(i))  # noqa: E731  (null beyond the end)
    has = lambda name: F.array_contains(lineage, name)
    root = at(0)
    out = F
    for name, division in KINGDOMS.items():
        out = out.when(root == name, division)
    return (
        out.when(has("Homo"), "human")
        .when((root == "Eukaryota") & (at(1) == "Fungi"), "fungi")
        .when(has("Rodentia"), "rodents")
        .when(has("Mammalia"), "mammals")
        .when((root == "Eukaryota") & (F.size(lineage) >= 4) & (at(2) == "Chordata") & (at(3) == "Craniata"), "vertebrates")
        .when(F.arrays_overlap(lineage, F.array(*map(F.lit, PLANT_CLADES))), "plants")
        .when(root == "Eukaryota", "invertebrates")
        .otherwise("unclassified")
    )


def taxon_group(lineage: Column, taxid: Column | None = None, overrides: dict[int, str] | None = None) -> Column:
    """The older classifier: overrides by taxid first, 'error' for no lineage, most rules under Eukaryota only (CLS-02).

    Lineages too short for a rule fall through to the next one.
    """
    at = lambda i: F.get(lineage, F.lit(i))
    has = lambda name: F.array_contains(lineage, name)
    root, eu = at(0), at(0) == "Eukaryota"
    out = F.when(lineage.isNull() | (F.size(lineage) == 0), "error")
    for name, division in KINGDOMS.items():
        out = out.when(root == name, division)
    plants = F.arrays_overlap(lineage, F.array(*map(F.lit, PLANT_CLADES + EXTRA_PLANT_CLADES))) | F.exists(lineage, lambda x: x.rlike("phyceae$"))
    out = (
        out.when(has("Homo"), "human")
        .when(eu & (at(1) == "Fungi"), "fungi")
        .when(eu & has("Rodentia"), "rodents")
        .when(eu & has("Mammalia"), "mammals")
        .when(eu & (at(2) == "Chordata") & (at(3) == "Craniata"), "vertebrates")
        .when(eu & plants, "plants")
        .when(eu, "invertebrates")
        .otherwise("unclassified")
    )
    if taxid is None or not overrides:
        return out
    names = F.create_map(*[F.lit(x) for k, v in overrides.items() for x in (int(k), v)])
    return F.coalesce(F.try_element_at(names, taxid.cast("int")), out)
