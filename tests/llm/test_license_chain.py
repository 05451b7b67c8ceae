"""Licence matches chain only in order and with bounded gaps."""

from __future__ import annotations

from listenlake.llm import license_scan

GPL = "this work is licensed under the gnu general public license version 3"


def test_scattered_and_out_of_order_fragments_are_no_notice():
    scan = license_scan.Scanner().scan
    early, late = "this work is licensed under the mit license", "affero general public license version 3"
    for text in [early + " x" * 500 + " " + late, late + " y " + early, late + " y" * 500 + " " + early]:
        found = scan(text)
        assert "gpl-3" not in found[5].split(",") and "gpl" not in found[7]
    # The notice of version 2 is covered to 11 of 12 words by that of version 3.
    assert scan("x y " + GPL + " z")[5:] == ("gpl-2,gpl-3", 1.0, "gpl-2:2-12,gpl-3:2-13")
    assert scan("this work is licensed under q the gnu general public license version 3")[7] == (
        "gpl-2:0-4,gpl-3:0-4,gpl-2:6-11,gpl-3:6-12")
    assert scan(GPL + " x" * 50 + " general public license version 3")[7] == "gpl-2:0-10,gpl-3:0-11"


def test_every_occurrence_and_shorter_match_is_chained():
    scanner = license_scan.Scanner({}, {"a b c d x a b c d y": "two", "w a b c d x a b c d y v": "longer"})
    assert scanner.scan("w a b c d x a b c d y v")[5] == "longer,two"
    assert scanner.scan("a b c d q a b c d y")[5:] == ("two", 0.9, "two:0-3,two:5-9")
    assert scanner.scan("")[5:] == ("", 0.0, "")


def test_spans_are_returned(spark):
    rows = spark.createDataFrame([(GPL,), ("",)], "text string").select(license_scan.scans(license_scan.F.col("text")).alias("s"))
    assert [r.spans for r in rows.select("s.spans").collect()] == ["gpl-2:0-10,gpl-3:0-11", ""]
