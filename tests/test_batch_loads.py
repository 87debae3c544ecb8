"""A batch opens the stored files that hold its objects, and spreads what it finds."""

from pathlib import Path

from pyspark.sql import functions as F

from folioflow.streaming import pipeline as sp


def stored(spark, folder, files=6, rows=50):
    """A table in ``files`` files, of which file n holds the objects that begin with ``n``."""
    for n in range(files):
        part = spark.range(rows).select(F.lit("b").alias("bucket"), F.concat(F.lit(f"{n}/"), "id", F.lit(".pdf")).alias("name"), F.lit(f"text {n}").alias("text"))
        part.coalesce(1).write.parquet(f"{folder}/n={n}")
    return spark.read.option("recursiveFileLookup", "true").parquet(folder).select("bucket", "name", "text")


def events(spark, names):
    return spark.createDataFrame([("b", name) for name in names], "bucket string, name string")


def test_files_without_objects_of_the_batch_are_not_opened(spark, tmp_path):
    table = stored(spark, str(tmp_path / "t"))
    asked = [f"{n}/{i}.pdf" for n in (1, 4) for i in range(40)]
    found = sp.from_table(table)(events(spark, [*asked, "gone.pdf"]))
    for n in (0, 2, 3, 5):
        for file in Path(tmp_path / "t" / f"n={n}").glob("*.parquet"):
            file.write_bytes(b"\0" * file.stat().st_size)
    assert sorted((r.bucket, r.name, r.text) for r in found.collect()) == sorted(("b", name, f"text {name[0]}") for name in asked)
    assert found.columns == ["bucket", "name", "text"]


def test_objects_of_one_file_are_spread(spark, tmp_path):
    found = sp.from_table(stored(spark, str(tmp_path / "t")))(events(spark, [f"2/{i}.pdf" for i in range(50)]))
    held = [n for n in found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert sum(held) == 50 and len(held) > 4


def test_tables_of_all_kinds_give_the_same_objects(spark, tmp_path, monkeypatch):
    table = stored(spark, str(tmp_path / "t"), 3, 5)
    names = spark.createDataFrame([("b", "0/1.pdf", "x"), ("b", None, "y"), ("b", "other.pdf", "z")], "bucket string, name string, extra string")
    kinds = {
        "files": table,
        "twice": table.unionByName(table),
        "spread": table.repartition(4),
        "rows": spark.createDataFrame(table.collect(), table.schema),
        "with null paths": names.join(table, ["bucket", "name"], "left").select("bucket", "name", "text"),
        "distinct": table.distinct(),
    }
    wanted = events(spark, ["0/1.pdf", "2/4.pdf", "other.pdf", "gone.pdf"])
    for most in (1000, 1):
        monkeypatch.setattr(sp, "NAMED_FILES", most)
        for kind, files in kinds.items():
            got = sorted(map(tuple, sp.from_table(files)(wanted).collect()), key=repr)
            assert got == sorted(map(tuple, files.join(wanted, ["bucket", "name"]).collect()), key=repr), (kind, most)


def test_a_batch_of_too_many_events_is_not_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sp, "SHARED_EVENTS", 3)
    found = sp.from_table(stored(spark, str(tmp_path / "t"), 2, 5))(events(spark, [f"1/{i}.pdf" for i in range(4)]))
    assert sorted(r.name for r in found.collect()) == [f"1/{i}.pdf" for i in range(4)]
