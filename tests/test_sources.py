from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from casewright.sources import artefacts, digest, reports, tabular


def test_equal_names_in_two_folders_stay_apart(spark, tmp_path):
    import hashlib

    lines = []
    for folder, text in (("a", "one"), ("b c", "two")):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "x.txt").write_text(text)
        lines.append(f"{hashlib.sha256(text.encode()).hexdigest()}  {folder}/x.txt")
    (tmp_path / "manifest").write_text("\n".join(lines))
    manifest = digest.read_manifest(spark, str(tmp_path / "manifest"))
    for root in (str(tmp_path / "in"), f"file://{tmp_path}/in/"):
        found = digest.file_digests(spark, root, below=True)
        assert {r.name for r in found.collect()} == {"a/x.txt", "b c/x.txt"}
        digest.verify_digests(found, manifest)
    (tmp_path / "in" / "a" / "x.txt").write_text("two")
    try:
        digest.verify_digests(digest.file_digests(spark, root, below=True), manifest)
    except ValueError as error:
        assert "a/x.txt" in str(error)
    else:
        raise AssertionError("a changed file passed")


def test_digest_of_names_with_spaces(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "two words.txt").write_bytes(b"abc")
    found = digest.file_digests(spark, str(tmp_path / "in"))
    row = found.first()
    assert row["name"] == "two words.txt"
    assert row["sha256"].startswith("ba7816bf8f01cfea")
    manifest = tmp_path / "sums"
    manifest.write_text(f"{row['sha256'].upper()}  two words.txt\n")
    digest.verify_digests(found, digest.read_manifest(spark, str(manifest)))
    manifest.write_text(f"{'0' * 64}  two words.txt\n")
    with pytest.raises(ValueError, match="mismatch"):
        digest.verify_digests(found, digest.read_manifest(spark, str(manifest)))
    manifest.write_text(f"{'0' * 64}  other.txt\n")
    with pytest.raises(ValueError, match="no entry"):
        digest.verify_digests(found, digest.read_manifest(spark, str(manifest)))


def test_six_digits(spark):
    df = spark.createDataFrame([(123456.789,), (0.000123456789,), (-2.0,), (0.0,), (None,)], "v double")
    out = [r[0] for r in df.select(reports.six_digits(F.col("v"))).collect()]
    assert out[:4] == pytest.approx([123457.0, 0.000123457, -2.0, 0.0]) and out[4] is None


def test_artefact_type_check(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(3).write.parquet(path)
    with pytest.raises(TypeError):
        artefacts.load_artefact(spark, path)


def test_read_or_compute_runs_once(spark, tmp_path):
    calls = []

    def stage():
        calls.append(1)
        return spark.range(5)

    for _ in range(2):
        assert tabular.read_or_compute(spark, str(tmp_path / "s"), stage).count() == 5
    assert len(calls) == 1


def test_digest_is_order_free(spark):
    df = spark.range(100)
    a, b = (artefacts.table_digest(df.repartition(p)).first() for p in (1, 5))
    assert a == b
