"""Rejected lines of text inputs are kept, and counted against a threshold."""

import pytest
from pyspark.sql import types as T

from aerocorr.sources import TooManyRejects, parse_cities, parse_sites, parse_text

CITY = ["1", '"Quoted Town', "Quoted Town", "", "50.1", "7.2", "P", "PPL", "DE", "", "", "", "", "",
        "1200", "", "80", "Europe/Berlin", "2019-01-01"]


def _sites(tmp_path):
    p = tmp_path / "sites.csv"
    p.write_text("latitude;longitude\n49.636;8.618\nabc;7.1\n;7.5\n51.294\n51.3;7.2;9\n51.294;7.199\n")
    return str(p)


def test_good_rows_and_rejects_share_no_line(spark, tmp_path):
    good, rejects = parse_sites(spark, _sites(tmp_path))
    assert sorted(map(tuple, good.collect()), key=str) == [(49.636, 8.618), (51.294, 7.199), (None, 7.5)]
    assert sorted(r.line for r in rejects.collect()) == ["51.294", "51.3;7.2;9", "abc;7.1"]
    assert all(r.source_file.endswith("sites.csv") for r in rejects.collect())


def test_threshold(spark, tmp_path):
    path = _sites(tmp_path)
    assert parse_sites(spark, path, max_share=0.5).good.count() == 3  # 3 of 6 is not more than a half
    with pytest.raises(TooManyRejects, match="3 of 6"):
        parse_sites(spark, path, max_share=0.49)


def test_gazetteer(spark, tmp_path):
    bad = ["2", "Ville", "Ville", "", "48.0", "2.0", "P", "PPL", "FR", "", "", "", "", "", "many", "35", "40", "x", "y"]
    p = tmp_path / "cities.txt"
    p.write_text("\n".join("\t".join(x) for x in (CITY, bad, CITY[:5])) + "\n")
    good, rejects = parse_cities(spark, str(p), country_code="DE")
    assert [(r.name, r.dem) for r in good.collect()] == [('"Quoted Town', 80)]
    assert sorted(r.line for r in rejects.collect()) == sorted(["\t".join(CITY[:5]), "\t".join(bad)])


def test_empty_file_clashing_names_and_store(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("line,rejected,source_file\n")
    schema = T.StructType([T.StructField("line", T.IntegerType()), T.StructField("rejected", T.StringType()),
                           T.StructField("source_file", T.StringType())])
    good, rejects = parse_text(spark, str(p), schema, header=True, max_share=0.0)
    assert good.collect() == [] and rejects.collect() == []
    p.write_text("line,rejected,source_file\n1,yes,f\nx,no,g\n")
    good, rejects = parse_text(spark, str(p), schema, header=True, store=str(tmp_path / "kept"))
    assert [tuple(r) for r in good.collect()] == [(1, "yes", "f")]
    p.unlink()  # both tables are served from the store
    assert [r.line for r in rejects.collect()] == ["x,no,g"]
