import datetime as dt

import pytest

from clinrisk.operators import explain as EX
from clinrisk.session import scratch_path
from clinrisk.sources import csv_ingest as CSV
from clinrisk.streaming.explanations import run_merge_stream

T = dt.datetime


def _raw(spark, path, rows):
    cols = [f" {CSV.ID_HEADER} "] + [f" {h} " for h, _, _ in CSV.RAW_COLUMNS]
    spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols)) \
        .write.option("header", True).csv(path)


HEADER = ",".join(f" {h} " for h, _, _ in CSV.RAW_COLUMNS)
LINE = 'ann lee,40,Female,A+,Asthma,2001-01-02 00:00:00,{d},X,10.5,101,Urgent,2001-01-05 00:00:00,Aspirin,Normal'


def _files(tmp_path, *files):
    for i, lines in enumerate(files):
        (tmp_path / f"part-{i:03}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(tmp_path)


def test_ids_are_row_positions_over_files(spark, tmp_path):
    path = _files(tmp_path, [LINE.format(d=f"a{i}") for i in range(500)], [LINE.format(d=f"b{i}") for i in range(3)])
    got = [(r.enc_id, r.doctor) for r in CSV.read_raw_csv(spark, path).orderBy("enc_id").collect()]
    assert got == [(i + 1, f"a{i}") for i in range(500)] + [(501 + i, f"b{i}") for i in range(3)]


def test_quotes_and_ragged_rows(spark, tmp_path):
    path = _files(tmp_path, [LINE.format(d='"O""Neil, Pat"'), LINE.format(d="x").rsplit(",", 3)[0], LINE.format(d="y") + ",more,fields"])
    rows, rejects = CSV.read_raw_csv(spark, path, tolerant=True)
    assert [(r.enc_id, r.doctor, r.test_results) for r in rows.collect()] == [(1, 'O"Neil, Pat', "Normal")]
    assert sorted((r.enc_id, r.bad_fields) for r in rejects.collect()) == [(2, ["(row)"]), (3, ["(row)"])]
    with pytest.raises(Exception):
        CSV.read_raw_csv(spark, path).collect()


def test_line_breaks_in_quotes_when_asked(spark, tmp_path):
    path = _files(tmp_path, [LINE.format(d='"two\nlines"'), LINE.format(d="z")])
    assert [r.doctor for r in CSV.read_raw_csv(spark, path, multi_line=True).orderBy("enc_id").collect()] == ["two\nlines", "z"]


def _row(i, age="40", admitted="2001-01-02T00:00:00", billing="10.5"):
    return (str(i), "ann lee", age, "Female", "A+", "Asthma", admitted, "Dr 1", "X", billing, "101",
            "Urgent", "2001-01-05T00:00:00", "Aspirin", "Normal")


def test_csv_strict_and_tolerant(spark):
    path = scratch_path(spark, "test-csv")
    _raw(spark, path, [_row(1), _row(2, age="forty"), _row(3, admitted="not a date", billing="x")])
    rows, rejects = CSV.read_raw_csv(spark, path, tolerant=True)
    got = {r.enc_id: r for r in rows.collect()}
    assert got[1].age == 40 and got[1].admission_date == T(2001, 1, 2) and got[1].billing == 10.5
    assert got[2].age is None
    assert {r.enc_id: sorted(r.bad_fields) for r in rejects.collect()} == {
        2: ["age"], 3: ["admission_date", "billing"]}
    with pytest.raises(Exception):
        CSV.read_raw_csv(spark, path).collect()


def test_streaming_merge_equals_batch_merge(spark):
    scores = spark.createDataFrame([(1, 7, 70, None), (2, 7, 70, None), (3, 8, 80, "old"), (4, 9, 90, None)],
                                   "score_id long, patient_id long, admission_id long, ai_explanation string")
    answers = spark.createDataFrame([(7, 70, 1, "first"), (8, 80, 1, "new"), (7, 70, 2, "second")],
                                    "patient_id long, admission_id long, seq int, explanation string")
    streamed = sorted(tuple(r) for r in run_merge_stream(scores, answers).collect())
    batch = sorted(tuple(r) for r in EX.merge_explanations(scores, answers).collect())
    assert streamed == batch == [(1, 7, 70, "second"), (2, 7, 70, "second"), (3, 8, 80, "new"), (4, 9, 90, None)]
