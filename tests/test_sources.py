import gzip
import hashlib
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tideline.contract import REQUIRED, SOURCE_COLUMNS
from tideline.sources import catalog, files, geojson, offers, tables

NEUTRAL = list(SOURCE_COLUMNS.values())


def write(path, lines, encoding="utf-8"):
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return str(path)


def record(n):
    return [f"{c.lower()} {n}" for c in REQUIRED]


def test_plain_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", [",".join([*REQUIRED, "EXTRA"]),
                                      *[",".join([*record(n), "x"]) for n in range(5)]])
    found = offers.read_offers(spark, path).orderBy("row_num").collect()
    assert [r["row_num"] for r in found] == [1, 2, 3, 4, 5]
    assert found[2].asDict() == {"row_num": 3, **dict(zip(NEUTRAL, record(2)))}


def test_missing_texts(spark, tmp_path):
    cells = ["N/A", "", "null", "Nadie", "NaN", "na", "None", "x", "#N/A", "NULL"]
    path = write(tmp_path / "n.csv", [",".join(REQUIRED), ",".join(cells), ",".join(["NA"] * 10)])
    found = offers.read_offers(spark, path).collect()
    assert [tuple(r) for r in found] == [
        (1, None, None, None, "Nadie", None, "na", None, "x", None, None)]


def test_header_further_down(spark, tmp_path):
    untidy = [f" {c.replace('_', ' ').lower()} " for c in REQUIRED]
    path = write(tmp_path / "b.csv", [
        "Published offers", "as of today,,", ",".join(untidy), ",".join(record(0)), "," * 9,
        ",".join(record(1)),
    ], "utf-8-sig")
    found = offers.read_offers(spark, path).orderBy("row_num").collect()
    # The empty record is dropped, and the numbers of the others stay.
    assert [(r["row_num"], r["provider"]) for r in found] == [
        (1, "nombre_ies 0"), (3, "nombre_ies 1")]


def test_row_numbers_across_blocks(spark, tmp_path):
    path = write(tmp_path / "c.csv", ["title", ",".join(REQUIRED),
                                      *[",".join(record(n)) for n in range(20000)]])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
    try:
        df = offers.read_offers(spark, path)
        assert df.rdd.getNumPartitions() > 1
        bad = df.where(F.col("provider") != F.concat(F.lit("nombre_ies "), F.col("row_num") - 1))
        assert bad.count() == 0 and df.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_a_folder_is_numbered_through(spark, tmp_path, kind):
    folder = tmp_path / "many"
    folder.mkdir()
    for i, size in enumerate((3, 1, 4)):
        rows = [record(f"{i}-{n}") for n in range(size)]
        if kind == "csv":
            write(folder / f"{i}.csv", ["title", ",".join(REQUIRED), *map(",".join, rows)])
        else:
            pq.write_table(
                pa.table(dict(zip(REQUIRED, map(list, zip(*rows))))), folder / f"{i}.parquet"
            )
    found = offers.read_offers(spark, str(folder), format=kind).orderBy("row_num").collect()
    assert [(r["row_num"], r["province"]) for r in found] == [
        (n + 1, f"provincia {label}") for n, label in enumerate(
            ["0-0", "0-1", "0-2", "1-0", "2-0", "2-1", "2-2", "2-3"])]


def test_a_packed_file_is_shared_out(spark, tmp_path):
    lines = ["title", ",".join(REQUIRED), *[",".join(record(n)) for n in range(500)]]
    with gzip.open(tmp_path / "p.csv.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    df = offers.read_offers(spark, str(tmp_path / "p.csv.gz"))
    bad = df.where(F.col("provider") != F.concat(F.lit("nombre_ies "), F.col("row_num") - 1))
    assert bad.count() == 0 and df.count() == 500
    assert df.select(F.spark_partition_id()).distinct().count() > 1


def test_quotes_and_line_breaks(spark, tmp_path):
    cells = ['Uni "A" x', "two\nlines", "a,b", *record(3)[3:]]
    quoted = ",".join('"' + c.replace('"', '""') + '"' for c in cells)
    path = write(tmp_path / "q.csv", ["Title, of a sheet", ",".join(REQUIRED), quoted, ",".join(record(1))])
    with pytest.raises(ValueError, match="multiline=True"):
        offers.read_offers(spark, path)
    found = offers.read_offers(spark, path, multiline=True).orderBy("row_num").collect()
    assert [tuple(r) for r in found] == [(1, *cells), (2, *record(1))]


def test_records_of_another_width_are_an_error(spark, tmp_path):
    for i, line in enumerate((",".join(record(1)[:-1]), ",".join([*record(1), "more"]))):
        path = write(tmp_path / f"w{i}.csv", [",".join(REQUIRED), ",".join(record(0)), line])
        with pytest.raises(ValueError, match="has not 10 cells"):
            offers.read_offers(spark, path)


def test_part_files_without_a_header_lose_nothing(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder / "0.csv", ["title", "", ",".join(REQUIRED), *[",".join(record(n)) for n in range(3)]])
    write(folder / "1.csv", [",".join(record(n)) for n in range(3, 9)])
    found = offers.read_offers(spark, str(folder), format="csv").orderBy("row_num").collect()
    assert [tuple(r) for r in found] == [(n + 1, *record(n)) for n in range(9)]
    write(folder / "2.csv", [",".join(REQUIRED[::-1]), ",".join(record(9))])
    with pytest.raises(ValueError, match="another header"):
        offers.read_offers(spark, str(folder), format="csv")


def test_rows_do_not_depend_on_the_parallelism(spark, tmp_path):
    path = write(tmp_path / "s.csv", ["title", ",".join(REQUIRED),
                                      *[",".join(record(n)) for n in range(20000)]])
    old = {k: spark.conf.get(k, None) for k in
           ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 4)
        spark.conf.set("spark.sql.files.maxPartitionBytes", 300_000)
        df = offers.read_offers(spark, path)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 7)
        spark.conf.set("spark.sql.files.maxPartitionBytes", 110_000)
        bad = df.where(F.col("provider") != F.concat(F.lit("nombre_ies "), F.col("row_num") - 1))
        assert bad.count() == 0 and df.count() == 20000
        assert df.select("row_num").distinct().count() == 20000
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_missing_columns(spark, tmp_path):
    path = write(tmp_path / "d.csv", [",".join(REQUIRED[:-1]), "1,2,3,4,5,6,7,8,9"])
    with pytest.raises(ValueError, match=r"Missing columns: \['ESTADO'\]"):
        offers.read_offers(spark, path)


def test_header_beyond_the_scan(spark):
    rows = [(n, *["x"] * 10) for n in range(50)] + [(50, *REQUIRED)]
    schema = "pos int, " + ", ".join(f"c{i} string" for i in range(10))
    cells = spark.createDataFrame(rows, schema)
    assert offers.find_header(cells) is None
    assert offers.find_header(cells, max_scan=51)[0] == 50
    with pytest.raises(ValueError, match="Missing columns"):
        offers.rows_below_header(cells)


def test_parquet_rows(spark, tmp_path):
    path = str(tmp_path / "e.parquet")
    rows = [tuple(record(n)) for n in range(4)]
    spark.createDataFrame(rows, ", ".join(f"`{c.title()}` string" for c in REQUIRED)).coalesce(
        1).write.parquet(path)
    found = offers.read_offers(spark, path).orderBy("row_num").collect()
    assert [r["provider"] for r in found] == [f"nombre_ies {n}" for n in range(4)]
    assert [r["row_num"] for r in found] == [1, 2, 3, 4]


def test_catalogue(spark, tmp_path):
    stored = write(tmp_path / "f.csv", [
        '"provincia","canton","provincia_norm","canton_norm","gid"',
        '"El Oro","Ñaño","eloro","nano","1"', '"Loja","Loja","loja","loja","2"'], "utf-8-sig")
    found = catalog.read_catalog(spark, stored).orderBy("ordinal").collect()
    assert [tuple(r) for r in found] == [("eloro", "nano", 0), ("loja", "loja", 1)]
    raw = write(tmp_path / "g.csv", ["provincia,canton", "El  Oro,Ñaño"])
    assert tuple(catalog.read_catalog(spark, raw).first()) == ("el oro", "nano", 0)
    other = write(tmp_path / "h.csv", ["a,b", "1,2"])
    assert catalog.read_catalog(spark, other) is None
    assert catalog.read_catalog(spark, str(tmp_path / "absent.csv")) is None


def test_geojson(spark, tmp_path):
    features = [{"type": "Feature", "properties": p, "geometry": {"type": "Point"}}
                for p in ({"NAME_1": "Cañar"}, {"NAME_1": "Loja", "NAME_2": " Loja"}, {"x": "y"})]
    path = tmp_path / "m.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1),
                    encoding="utf-8")
    found = geojson.read_geojson(spark, str(path), "NAME_1").select(
        "name_norm", "province_norm", "canton_norm", "geometry").collect()
    assert [tuple(r)[:3] for r in found] == [
        ("canar", "canar", None), ("loja", "loja", "loja"), ("", None, None)]
    assert json.loads(found[0]["geometry"]) == {"type": "Point"}


def test_checksums_whole_and_in_pieces(spark, tmp_path):
    contents = {f"{n}.bin": bytes([n]) * (n * 1000) for n in range(1, 6)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    for whole in (10**9, 2500, 0):
        found = {r["path"].split("/")[-1]: (r["size"], r["checksum"])
                 for r in files.file_checksums(spark, str(tmp_path), whole=whole).collect()}
        assert found == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}


def test_missing_table_and_added_column(spark, tmp_path):
    assert tables.read_table(spark, str(tmp_path / "none"), "a int").count() == 0
    spark.range(2).select(F.col("id").cast("int").alias("a")).write.parquet(str(tmp_path / "t"))
    grown = tables.read_table(spark, str(tmp_path / "t"), "a int, b string")
    assert {r["b"] for r in grown.collect()} == {None}


def test_read_view(spark):
    spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "k string, n int").createOrReplaceTempView("v")
    found = tables.read_view(spark, "v", ["k"], ["n.desc"], 2).collect()
    assert [r["k"] for r in found] == ["b", "c"]
