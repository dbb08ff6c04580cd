"""Files with what does not parse beside the data; columns found by header."""

import datetime
import gzip

import domain
import pytest

from snowloom import sinks, sources
from snowloom.plans import staging

SCHEMA = "id int, name string, born date"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def folder(tmp_path, **files):
    for name, text in files.items():
        if name.endswith("_gz"):
            (tmp_path / f"{name[:-3]}.csv.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_rows_and_rejects(spark, tmp_path):
    path = folder(
        tmp_path,
        a='id,name,born\n1,"A, B",2000-01-01\n2,b\n3,c,2000-01-02,x\n4,,\n',
        b='Born;Name\n',
        c='Born,extra,"Full Name",ID\n2001-02-03,e,d,5\nnever,e,"q\\"",6\n,,,\n',
        d_gz="\ufeffid,name,born\n7,é,2002-01-01\n8\n",
        e="",
        f="id,name,born,NAME\n9,x,,y\n",
        g="id,name,born\n",
    )
    (tmp_path / "_SUCCESS").write_text("no,data\n1,2\n")
    read = sources.read_csv_checked(spark, path, SCHEMA, {"name": ["Full Name"]})
    day = datetime.date
    assert rows(read.rows) == sorted(
        [(1, "A, B", day(2000, 1, 1)), (4, None, None), (5, "d", day(2001, 2, 3)), (6, 'q"', None), (None, None, None), (7, "é", day(2002, 1, 1))], key=repr
    )
    found = {(r.file.rpartition("/")[2], r.reason, r.raw) for r in read.rejects.collect()}
    assert found == {
        ("a.csv", "wrong number of fields", "2,b"), ("a.csv", "wrong number of fields", "3,c,2000-01-02,x"),
        ("d.csv.gz", "wrong number of fields", "8"), ("b.csv", "header without born, id, name", "Born;Name"), ("f.csv", "header has name twice", "id,name,born,NAME"),
    }
    assert read.rows.dtypes == [("id", "int"), ("name", "string"), ("born", "date")]


def test_nothing_to_read(spark, tmp_path):
    read = sources.read_csv_checked(spark, folder(tmp_path), SCHEMA)
    assert read.rows.collect() == [] and read.rejects.collect() == []
    read = sources.read_csv_checked(spark, folder(tmp_path, a="other\n1\n"), SCHEMA)
    assert read.rows.collect() == [] and read.rejects.count() == 1


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "name": "a"}\n{"id": 2, "name"\n[1]\n{"id": "x"}\n{"id": 3, "other": 1}\n\n')
    read = sources.read_json_checked(spark, str(tmp_path), "id int, name string")
    assert rows(read.rows.where("id is not null")) == [(1, "a"), (3, None)]
    assert {r.raw for r in read.rejects.collect()} >= {'{"id": 2, "name"', '{"id": "x"}'}


@pytest.mark.parametrize("header, want", [("Laureate ID", "laureate_id"), (" laureate-id ", "laureate_id"), ("Prize  Share (%)", "prize_share"), ("", "")])
def test_plain_name(header, want):
    assert sources.plain_name(header) == want


def test_laureates_by_header(spark, tmp_path):
    """The columns of the laureate files in reverse order; one line breaks off."""
    sinks.ensure_database(spark, "stg_checked", reset=True)
    sorted_rows = domain.LAUREATES
    plain = domain.write_csv(f"{tmp_path}/plain", domain.LAUREATE_HEADER, sorted_rows)
    turned = domain.write_csv(f"{tmp_path}/turned", domain.LAUREATE_HEADER[::-1], [r[::-1] for r in sorted_rows])
    with open(f"{turned}/more.csv", "w") as out:
        out.write(",".join(f'"{c}"' for c in domain.LAUREATE_HEADER) + "\n1901,Peace\n")
    staging.land_laureates(spark, plain, "stg_checked.plain", "2024-01-07")
    for _ in range(2):
        staging.land_laureates_by_header(spark, turned, "stg_checked.turned", "2024-01-07")
    assert rows(spark.table("stg_checked.turned")) == rows(spark.table("stg_checked.plain"))
    (reject,) = spark.table("stg_checked.turned__rejects").collect()
    assert (reject.reason, reject.raw) == ("wrong number of fields", "1901,Peace")
