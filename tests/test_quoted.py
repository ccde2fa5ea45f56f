"""Split reading of quoted files against the multi-line reader."""

import random

import pytest

from screensift.sources import files as io
from screensift.sources import quoted

HEADER = "title\tabstract\tincluded\n"


def field(rng):
    text = "".join(rng.choice(["word ", "é", "x", "\t", "\n", '"', "5 inch ", "-", " "]) for _ in range(rng.randint(0, 14)))
    if rng.random() < 0.4:
        return text.replace("\t", " ").replace("\n", " ").replace('"', "")
    return '"' + text.replace('"', '""') + '"'


def write(path, rows, rng, stray=False):
    with open(path, "w", newline="") as f:
        f.write(HEADER)
        for i in range(rows):
            cells = [field(rng) or "e", field(rng), str(i)]
            if stray and i % 5 == 0:
                cells[0] = 'pipe 5" wide'  # a quote inside an unquoted field is text
            f.write("\t".join(cells) + "\n")
            if i % 17 == 0:
                f.write("\n")


@pytest.mark.parametrize("stray", [False, True])
def test_split_reader_equals_multiline_reader(spark, tmp_path, stray):
    rng = random.Random(stray)
    for name in ("a", "b"):
        write(tmp_path / f"{name}.tsv", 60, rng, stray)
    columns = {"title": "title", "abstract": "abstract", "included": "label"}
    want = spark.read.options(**io.TSV_OPTIONS).csv(str(tmp_path)).select(*[io._na_to_null(h).alias(n) for h, n in columns.items()])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
              if spark.conf.get(k, None)}
    try:
        for size in ("150", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = io.read_tsv(spark, str(tmp_path), columns)
            assert sorted(map(str, got.drop("doc_id").collect())) == sorted(map(str, want.collect()))
            assert got.select("doc_id").distinct().count() == got.count() == 120
            blocks = quoted._lines(spark, str(tmp_path)).select("file", "block").distinct().count()
            assert blocks > 10 if size != "100000" else blocks >= 2
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        for k, v in before.items():
            spark.conf.set(k, v)


def test_line_states():
    cases = {"plain": (False, True), '"open': (True, False), 'a"b': (False, False), '"a""b"\tc': (False, False), 'x\t"y': (True, False),
             'end"\tz': (False, False), 'end"\t"again': (True, True), '""': (False, True), '"a"tail"\tb': (False, False)}
    for line, (outside, inside) in cases.items():
        assert quoted.ends_inside(line, False) == outside, line
    assert quoted.ends_inside('end"\t"again', True) and not quoted.ends_inside('end"\tz', True) and quoted.ends_inside("no quote", True)
