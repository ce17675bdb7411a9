from pathlib import Path

import pytest
from pyspark.sql import functions as F

from yearwheel.operators.staging import Staging
from yearwheel.plans.run import new_run_id
from yearwheel.session import shuffle_partitions
from yearwheel.sinks import write_bundle, write_table
from yearwheel.sources import column_mismatch, read_bundle, read_classification, read_lookup, read_purposes, read_table
from yearwheel.sources.manifest import NotPublished, SharedFiles
from yearwheel.sources.schemas import SPEND, TRIPS


def text(folder):
    return [p.read_bytes() for p in sorted(Path(folder).glob("part-*"))]


def test_fact_tables_are_typed_and_pruned(spark, tmp_path, rows, plan):
    file = tmp_path / "spend.csv"
    file.write_text('"Extra","ImputedSpendAmt","SpendType","TripID"\n1,10.5,"Other   ",7\nNA,NA,Alcohol,NA\n2,,,8\n')
    df = read_table(spark, str(file), SPEND)
    assert df.dtypes == [("TripID", "bigint"), ("SpendType", "string"), ("ImputedSpendAmt", "double")]
    assert rows(df) == [(None, "Alcohol", None), (7, "Other   ", 10.5), (8, None, None)]
    assert "Extra" not in plan(df.select("TripID"))
    exact = read_table(spark, str(file), SPEND, number="decimal(18,2)")
    assert dict(exact.dtypes)["ImputedSpendAmt"] == "decimal(18,2)"


def test_absent_columns_and_bad_values_are_errors(spark, tmp_path):
    file = tmp_path / "spend.csv"
    file.write_text("TripID,SpendType,ImputedSpendAmt\n1,Alcohol,much\n")
    with pytest.raises(ValueError, match="no column TripIDNumber"):
        read_table(spark, str(file), TRIPS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_table(spark, str(file), SPEND).collect()


def test_lookup_with_crlf_and_commas_in_quotes(spark, tmp_path, rows):
    file = tmp_path / "lookup.csv"
    file.write_bytes(b'Code,Description,SortOrder\r\n1,"Lodges, Retreats",1\r\n2,"All",2\r\n')
    assert rows(read_lookup(spark, str(file))) == [(1, "Lodges, Retreats", 1), (2, "All", 2)]
    file.write_text("Description,Code,SortOrder\nx,1,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_lookup(spark, str(file)).collect()


@pytest.mark.parametrize(("end", "line_sep"), [("\r\n", "\r\n"), ("\n", None)])
def test_purposes_with_line_feeds_and_repeated_names_in_the_header(spark, tmp_path, rows, end, line_sep):
    header = 'Code,Purpose,Group Code,"Group\n(first)",B,B text,Group Code,"Group\n(second)"'
    lines = [header, "411,Education,P4,Other,B2,No,P4,Learning", "0,None,P4,Other,B2,No,P96,Other"]
    file = tmp_path / "purposes.csv"
    file.write_bytes((end.join(lines) + end).encode())
    assert rows(read_purposes(spark, str(file), line_sep=line_sep)) == [("Education", "Learning"), ("None", "Other")]


def test_classification_is_filled_down_and_respelled(spark, tmp_path, rows):
    file = tmp_path / "classes.csv"
    file.write_text("pos,code,group,acode,activity\n1,A,Outdoor,1,Walk in City\n2,NA,NA,2,Fishing\n3,B,Arts,3,Arts and Crafts\n")
    df = read_classification(spark, str(file), group="group", activity="activity")
    assert rows(df) == [("Arts", "Arts And Crafts"), ("Outdoor", "Fishing"), ("Outdoor", "Walk In City")]


def test_tables_are_written_byte_for_byte(table, tmp_path):
    records = [(1, '"a, b"', "Other   "), (2, '"  c"', ""), (3, 'say "hi"', None)]
    write_table(table("Code int, Description string, SortOrder string", records).coalesce(1), str(tmp_path / "t"))
    assert text(tmp_path / "t") == [
        b'Code,Description,SortOrder\n1,"a, b",Other   \n2,"  c",\n3,say "hi",NA\n'
    ]


def test_every_part_has_a_header_and_paths_are_not_overwritten(table, tmp_path):
    df = table("a int", [(i,) for i in range(10)]).repartition(3)
    write_table(df, str(tmp_path / "t"))
    parts = text(tmp_path / "t")
    assert len(parts) == 3 and all(p.startswith(b"a\n") for p in parts)
    with pytest.raises(Exception, match="already exists"):
        write_table(df, str(tmp_path / "t"))


def test_empty_tables_keep_their_header(table, tmp_path):
    write_table(table("a int, b int", []).coalesce(1), str(tmp_path / "t"))
    assert b"".join(text(tmp_path / "t")) == b"a,b\n"


def test_bundle_conformance_names_misplaced_columns(spark, table, tmp_path):
    index = lambda kind, codes: table(f"{kind}Code string, {kind}Title string", [(f'"{c}"', '"t"') for c in codes])
    tables = {
        "Data1": table("B string, A string, M string", [("1", "1", "5")]),
        "DimenLookupA1": table("Code int, Description string, SortOrder string", [(1, '"All"', "")]),
        "DimenLookupB1": table("Code int, Description string, SortOrder string", [(1, '"All"', "")]),
        "DimenHierarchyA1": table("Parent int, Child int", []),
        "DimenHierarchyB1": table("Parent int, Child int", []),
        "DimensionIndex": index("Dimension", ["A", "B"]),
        "MeasureIndex": index("Measure", ["M"]),
        "FileIndex": table("TableID string, TableCode string", [("1", "T")]),
    }
    write_bundle(tables, str(tmp_path / "b"))
    bundle = read_bundle(spark, str(tmp_path / "b"))
    assert column_mismatch(bundle) == [("B", "A"), ("A", "B")]
    assert bundle.raw_lookups["A"].first().Description == '"All"'
    assert bundle.lookups["A"].first().Description == "All"
    assert bundle.raw_indexes["MeasureIndex"].first().MeasureCode == '"M"'
    assert bundle.measure_index.first().MeasureCode == "M"


def test_a_broken_bundle_is_never_read_and_does_not_block(spark, table, tmp_path):
    """A failure between tables leaves nothing under the bundle's name; the next run publishes it."""
    good = table("a int", [(1,)])
    bad = good.select(F.raise_error(F.lit("broken")).cast("int").alias("a"))
    folder = str(tmp_path / "b")
    with pytest.raises(Exception, match="broken"):
        write_bundle({"Data1": good, "FileIndex": bad}, folder)
    assert not Path(folder).exists()
    with pytest.raises(NotPublished):
        read_bundle(spark, folder)
    # a crash between the renaming and the manifest
    write_table(good, f"{folder}/Data1.csv")
    with pytest.raises(NotPublished):
        read_bundle(spark, folder)
    write_bundle({"Data1": good, "FileIndex": good}, folder)
    assert SharedFiles(spark, folder).tables() == ["Data1", "FileIndex"]
    (kept,) = Path(tmp_path).glob("b.incomplete-*")
    assert (kept / "Data1.csv").exists()
    with pytest.raises(FileExistsError, match="already exists"):
        write_bundle({"Data1": good}, folder)


def test_shuffle_partitions_follow_the_facts():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(100 * 2**40) == 100 * 2**40 // (256 * 2**20)


def test_staging_uses_the_folder_the_session_names(spark, table):
    named = spark.conf.get("spark.checkpoint.dir", None)
    stage = Staging(spark)
    assert stage.folder.startswith(named.rstrip("/") if named else "/")
    staged = stage(table("a int", [(1,), (2,)]), "t")
    assert staged.count() == 2 and stage.folder in staged.inputFiles()[0]
    stage.drop()
    assert not Path(stage.folder.removeprefix("file:")).exists()


def test_run_ids():
    run_id = new_run_id()
    assert len(run_id) == 13 and run_id[8] == "-" and run_id.replace("-", "").isdigit()
