import zipfile

import pytest
from pyspark.sql import functions as F

from newsvault.functions import ts_lit
from newsvault.operators import staging
from newsvault.sources import feed_files, tables
from tests.helpers import DAY1, article, raw, raw_row, staged


def test_tone_text_shapes(spark):
    tones = {"a": "1.5,2", "b": "x,1,2,3,4,5,10", "c": "1,2,3,4,5,6,12.7",
             "d": "1,2,3,4,5,6,7,8", "e": None}
    got = {r.gkg_record_id: r for r in staged(
        spark, *[article(k, tone=v) for k, v in tones.items()]).collect()}
    assert (got["a"].tone_overall, got["a"].tone_positive, got["a"].tone_negative,
            got["a"].word_count) == (1.5, 2.0, None, 0)
    assert (got["b"].tone_overall, got["b"].word_count) == (None, 10)
    assert got["c"].word_count == 12
    assert got["d"].word_count == 0
    assert (got["e"].tone_overall, got["e"].word_count) == (None, 0)


def test_bad_date_is_kept_and_null_id_dropped(spark):
    got = staged(spark, article("a", ts="2026x"), article(None), article("NA")).collect()
    assert [(r.gkg_record_id, r.event_datetime) for r in got] == [("a", None)]


def test_missing_value_words_only_when_wanted(spark):
    df = raw(spark, article("NA"))
    assert staging.parse(df, ts_lit(DAY1), na_as_null=False).first().gkg_record_id == "NA"


def test_theme_filter(spark):
    df = raw(spark, raw_row(c0="a", c8=None), raw_row(c0="b", c8="ECON_MONEYLAUNDERING_X"),
             raw_row(c0="c", c8="TAX"))
    assert [r._c0 for r in staging.theme_filter(df).collect()] == ["b"]


def test_load_statistics(spark):
    stats = staging.load_statistics(staged(
        spark, article("a"), article("b", locations=None),
        article("c", locations="1#a#US#;1#b#CA#"))).first()
    assert (stats.n_rows, stats.country_mentions) == (3, 3)


def test_tsv_keeps_quotes_and_pads_short_lines(spark, tmp_path):
    (tmp_path / "2026a.bronze.csv").write_bytes(
        b'a\t"x\ty\n' + b"\t".join(b"%d" % i for i in range(30)) + b"\nbad\xff\tNA\n")
    (tmp_path / "2025a.bronze.csv").write_text("old\n")
    df = feed_files.read_tsv(spark, str(tmp_path), "2026*.bronze.csv")
    got = {r._c0: r for r in df.collect()}
    assert set(got) == {"a", "0", "bad�"}
    assert got["a"]._c1 == '"x' and got["a"]._c2 == "y" and got["a"]._c3 is None
    assert got["0"]._c26 == "26"
    assert got["bad�"]._c1 == "NA"
    assert got["a"].source_file.endswith("2026a.bronze.csv")
    clean = feed_files.drop_bad_chars(df, ["_c0"])
    assert "bad" in {r._c0 for r in clean.collect()}


def test_width_check(spark, tmp_path):
    (tmp_path / "f.csv").write_text("\t".join("x" * 27) + "\n" + "a\tb\n")
    lines = feed_files.read_lines(spark, str(tmp_path))
    got = sorted((r.fields, r.width_ok) for r in feed_files.check_width(lines).collect())
    assert got == [(2, False), (27, True)]
    with pytest.raises(Exception, match="expected 27 fields, found 2"):
        feed_files.require_width(lines).collect()


def test_zip_scan_and_damaged_archive(spark, tmp_path):
    line = "\t".join(["id1", "20260101000000"] + [""] * 25)
    with zipfile.ZipFile(tmp_path / "20260101000000.gkg.csv.zip", "w") as z:
        z.writestr("a.csv", (line + "\n").encode() + b"id2\xff\tx\r\n")
    (tmp_path / "20260101001500.gkg.csv.zip").write_bytes(b"not a zip")
    lines = feed_files.read_zip_lines(spark, str(tmp_path))
    errors = [r.error for r in lines.where("error IS NOT NULL").collect()]
    assert errors == ["not a readable zip archive: File is not a zip file"]
    got = {r._c0: r for r in feed_files.split_lines(lines).collect()}
    assert set(got) == {"id1", "id2"}
    assert got["id1"]._c2 is None and got["id2"]._c1 == "x" and got["id2"]._c5 is None


def test_file_states(spark, tmp_path):
    whole, cut = b"a\tb\n" * 5, b"a\tb\n" * 3 + b"a"
    for name, content in (("whole", whole), ("cut", cut), ("empty", b"")):
        (tmp_path / f"{name}.csv").write_bytes(content)
    listing = feed_files.listed_files(spark, str(tmp_path), "*.csv")
    coverage = feed_files.file_coverage(spark, str(tmp_path), "*.csv")
    got = {r.source_file.rsplit("/", 1)[1]: (r.state, r.n_lines) for r in feed_files.file_states(listing, coverage).collect()}
    assert got == {"whole.csv": ("complete", 5), "cut.csv": ("cut", 4), "empty.csv": ("empty", 0)}
    half = coverage.withColumns({"bytes_read": F.col("bytes_read") - 8})
    states = {r.state for r in feed_files.file_states(listing, half).collect()}
    assert states == {"partly read", "empty"}
    unread = feed_files.file_states(listing, coverage.where("false")).collect()
    assert sorted(r.state for r in unread) == ["empty", "unread", "unread"]


def test_seed_keeps_the_code_na(spark, tmp_path):
    (tmp_path / "dim.csv").write_text(
        "country_code,country_name,capital_city,capital_latitude,capital_longitude,"
        "continent,region\nNA,Namibia,Windhoek,-22.5,17.1,Africa,Southern Africa\n")
    row = tables.read_seed(spark, str(tmp_path / "dim.csv")).first()
    assert (row.country_code, row.capital_latitude) == ("NA", -22.5)


def test_external_table_options():
    options = tables.jdbc_options("jdbc:x://h/db", "gold.t", "id", 1, 100, 8, user="u")
    assert options["dbtable"] == "gold.t" and options["numPartitions"] == "8"
    assert options["partitionColumn"] == "id" and options["user"] == "u"
    assert "partitionColumn" not in tables.jdbc_options("jdbc:x://h/db", "t")


def test_registry(spark):
    registry = tables.TableRegistry(spark)
    registry.add_view("gold", "t", spark.range(3).withColumn("x", F.lit(1)))
    assert registry.table("gold", "t").count() == 3
    assert registry.names() == ["gold.t"]


def test_task_functions_travel_by_value(tmp_path):
    """A worker in another folder, without this package on its path, can load them."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    blob = tmp_path / "f.pkl"
    blob.write_bytes(cloudpickle.dumps(feed_files._unzip_lines))
    code = f"import pickle; print(callable(pickle.load(open({str(blob)!r}, 'rb'))))"
    out = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True,
                         env={"PATH": "/usr/bin:/bin"})
    assert out.stdout.strip() == "True", out.stderr
