"""Nested records for the tests of tables, sources and lakes."""

from __future__ import annotations

from pyspark.sql import types as T

from lakeloom.operators.schema import parse_type

SCHEMA: T.StructType = parse_type(
    "STRUCT(entryType VARCHAR, primaryAccession VARCHAR, uniProtkbId VARCHAR, organism STRUCT(scientificName VARCHAR, taxonId BIGINT, lineage VARCHAR[]),"
    " genes STRUCT(geneName STRUCT(value VARCHAR))[], features STRUCT(type VARCHAR, location STRUCT(start STRUCT(value BIGINT), \"end\" STRUCT(value BIGINT)), description VARCHAR)[],"
    " comments MAP(VARCHAR, JSON)[], keywords VARCHAR[], sequence STRUCT(value VARCHAR, length BIGINT, molWeight BIGINT, md5 VARCHAR))"
)

LINEAGES = [
    (["Bacteria", "X"], "bacteria", "bacteria"), (["Archaea"], "archaea", "archaea"), (["Viruses"], "viruses", "viruses"),
    (["Eukaryota", "Metazoa", "Chordata", "Craniata", "Mammalia", "Homo"], "human", "human"), (["Eukaryota", "Fungi", "X", "Y"], "fungi", "fungi"),
    (["Eukaryota", "Metazoa", "Chordata", "Craniata", "Mammalia", "Rodentia"], "rodents", "rodents"), (["Eukaryota", "Metazoa", "Chordata", "Craniata", "Mammalia"], "mammals", "mammals"),
    (["Eukaryota", "Metazoa", "Chordata", "Craniata", "Actinopterygii"], "vertebrates", "vertebrates"), (["Eukaryota", "Viridiplantae", "Streptophyta"], "plants", "plants"),
    (["Eukaryota", "Sar", "Phaeophyceae", "X"], "invertebrates", "plants"), (["Eukaryota", "Discoba", "Euglenida", "X"], "invertebrates", "plants"),
    (["Eukaryota", "Metazoa", "Arthropoda", "X"], "invertebrates", "invertebrates"), (["Eukaryota"], "invertebrates", "invertebrates"),
    (["Other", "Rodentia"], "rodents", "unclassified"), ([], "unclassified", "error"), (None, "unclassified", "error"),
]
TYPES = ["UniProtKB reviewed (Swiss-Prot)", "UniProtKB unreviewed (TrEMBL)", None, "other"]


def record(i: int) -> dict:
    feature = lambda k: {"type": "ABC"[k % 3], "location": {"start": {"value": 5 * k}, "end": {"value": 5 * k + 7} if k % 4 else None}, "description": f"f{k}"}
    return {
        "entryType": TYPES[i % 4], "primaryAccession": f"P{i:04d}", "uniProtkbId": f"ID{i}", "organism": {"scientificName": f"org {i % 5}", "taxonId": i, "lineage": LINEAGES[i % len(LINEAGES)][0]},
        "genes": [None, [], [{"geneName": None}], [{"geneName": {"value": f"g{i}"}}]][i % 4], "features": [None, [], [feature(k) for k in range(i % 6)]][i % 3],
        "comments": [{"note": {"a": i}, "kind": "FUNCTION"}] if i % 2 else None, "keywords": ["k"] if i % 3 else None, "sequence": {"value": "MCAC" * (i + 1), "length": 4 * (i + 1), "molWeight": 100 * i, "md5": f"m{i}"},
    }


RECORDS = [record(i) for i in range(48)]
