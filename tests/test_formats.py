"""Queries that write a format and read it back: they hold all rows, not a part of them."""

from conftest import SF01

from capset.plans import QUERIES
from capset.plans.registry import load


def test_fault_report_of_all_documents(spark):
    """Every file without its other side is in the file that is read back, whatever its id."""
    texts = {r.doc_id for r in load(spark, SF01, "labels").collect()}
    images = {r.doc_id for r in load(spark, SF01, "documents").where("lang <> 'fr'").collect()}
    got = QUERIES["fault_rows_file"](spark, SF01).where("kind = 'incomplete'").collect()
    assert sorted(int(r.file.split(".")[0]) for r in got) == sorted(texts ^ images)
