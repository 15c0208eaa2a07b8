"""Readers and writers."""

import random

import pytest

from encore.sources.catalog import Catalog, read_csv, write_csv
from encore.sources.quoted_lines import quoted_lines, read_quoted_csv
from encore.sources.schemas import RAW


def test_csv_text_round_trip(spark, tmp_path):
    rows = [("r1", "o1", 5, None, 'two\nlines, "quoted"', None, None), ("r2", "o2", 1, None, " ", None, None)]
    df = spark.createDataFrame(rows, RAW["reviews"])
    write_csv(df, str(tmp_path / "r"))
    back = read_csv(spark, str(tmp_path / "r"), RAW["reviews"], multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_zip_codes_keep_their_zeros(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "sellers").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01234,x,SP\n")
    catalog = Catalog(spark, str(tmp_path))
    assert catalog.load("sellers").first().seller_zip_code_prefix == "01234"


def test_catalog_formats(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    df = spark.createDataFrame(
        [(1, 2, None)],
        "total_pseudo_positives long, positives_from_top_categories long, "
        "percentage_top_category double",
    )
    for name in ("mega_id_labels", "logistic_metrics", "ssl_bias_report"):  # null metrics stay
        back = catalog.save(df, name)
        assert back.dtypes == df.dtypes and back.collect() == df.collect()
    assert catalog.load("ssl_bias_report").dtypes == df.dtypes
    assert "percentage_top_category" in catalog.load("logistic_metrics").columns


SCHEMA = "id long, note string, score double, tail string"


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in BLOCKS}
    yield lambda size: [spark.conf.set(k, str(v)) for k, v in zip(BLOCKS, (size, size, 1000))]
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


BLOCKS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
          "spark.sql.files.minPartitionNum")


def quoted_text(rng):
    pieces = ["a", "b c", "\n", '""', ",", "\n\n", "é", "long " * 30, ' "" ', "x\ny"]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))


@pytest.mark.parametrize("seed,block", [(1, 64), (2, 200), (3, 1000), (4, 100_000)])
def test_quoted_breaks_in_split_files(spark, tmp_path, small_blocks, seed, block):
    """Equal to the reader of whole files, with quotes and breaks on both sides of every border."""
    rng = random.Random(seed)
    folder = tmp_path / "notes"
    folder.mkdir()
    for name in "ab":
        out = ['id,note,"sco""re",tail']
        for i in range(120):
            note = rng.choice([f'"{quoted_text(rng)}"', "plain", "", '""'])
            out.append(f"{i},{note},{rng.choice(['1.5', '', 'x'])},{rng.choice(['t', '', '"q"'])}")
            if rng.random() < 0.05:
                out.append("")
        (folder / f"{name}.csv").write_text("\n".join(out) + rng.choice(["", "\n"]))
    plain = spark.read.schema(SCHEMA).option("header", True).option("escape", '"')
    wanted = plain.option("multiLine", True).csv(str(folder)).collect()
    small_blocks(block)
    tasks = spark.read.text(str(folder)).rdd.getNumPartitions()
    assert tasks > 100_000 // (block * 20)
    got = read_quoted_csv(spark, str(folder), SCHEMA).collect()
    assert sorted(map(str, got)) == sorted(map(str, wanted)) and len(got) == 240


def test_quoted_lines_edges(spark, tmp_path, small_blocks):
    small_blocks(16)
    (tmp_path / "one.csv").write_text('"h\n1",b\r\n1,"x\r\ny"\r\n2,"open\nto the end\n3,z')
    got = {r.record: r.first for r in quoted_lines(spark, str(tmp_path / "one.csv")).collect()}
    assert got == {'"h\n1",b': True, '1,"x\r\ny"': False, '2,"open\nto the end\n3,z': False}
    (tmp_path / "none.csv").write_text("")
    assert read_quoted_csv(spark, str(tmp_path / "none.csv"), SCHEMA).collect() == []
    (tmp_path / "head.csv").write_text("id,note,score,tail")
    assert read_quoted_csv(spark, str(tmp_path / "head.csv"), SCHEMA).collect() == []


def test_read_quoted_csv_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\n\"b\"", 0.5, None), (2, None, None, " x ")], SCHEMA)
    write_csv(df, str(tmp_path / "t"))
    back = read_quoted_csv(spark, str(tmp_path / "t"), df.schema)
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
