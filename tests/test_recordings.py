import io
import math
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid import constants as C
from tastegrid.operators import extract, frames, resume, rollup
from tastegrid.plans import prepare
from tastegrid.sources.audio import audio_files
from tastegrid.streaming.new_files import start_extraction
from tastegrid.streaming.stateful_files import chosen_files, feature_schema, read_batches, start_stateful_extraction


def test_frame_stats(spark):
    rows = [(1, [1.0, 2.0, 4.0]), (2, [5.0]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "k long, s array<float>")
    got = {r["k"]: tuple(r)[1:] for r in frames.frame_stats(df, "k", "s").collect()}
    assert got[1][:2] == (3, 1.0) and math.isclose(got[1][2], 7 / 3) and math.isclose(got[1][3], np.std([1, 2, 4]))
    assert got[2] == (1, 5.0, 5.0, 0.0)
    assert got[3][1:] == (None, None, None) and got[4][1:] == (None, None, None)


def test_audio_features(spark):
    rng = np.random.default_rng(1)
    shapes = {"mfcc": 20, "chroma": 12, "contrast": 7}
    data = {name: rng.normal(size=(n, 9)) for name, n in shapes.items()}
    rms = rng.normal(size=9)
    row = (5, data["mfcc"].tolist(), [120.5, 60.0], rms.tolist(), data["chroma"].tolist(), data["contrast"].tolist())
    m = "array<array<double>>"
    df = spark.createDataFrame([row], f"musicnet_id long, mfcc {m}, tempo array<double>, rms array<double>, chroma {m}, contrast {m}")
    got = frames.audio_features(df)
    assert got.columns == ["musicnet_id", *C.AUDIO_FEATURES] and len(C.AUDIO_FEATURES) == 61
    got = got.first()
    assert got["tempo"] == 120.5 and math.isclose(got["rms_mean"], rms.mean())
    for name, n in shapes.items():
        for i in range(n):
            assert math.isclose(got[f"{name}_{i + 1}_mean"], data[name][i].mean())
    assert all(math.isclose(got[f"mfcc_{i + 1}_std"], data["mfcc"][i].std()) for i in range(20))


FEATURES = "musicnet_id long, a double, b double"
MAP = "artist_id long, artist string, musicnet_id long, composer_raw string, match_key string, match_type string"


def test_rollup(spark):
    features = spark.createDataFrame([(9, float("nan"), 1.0), (10, 2.0, 3.0), (11, 5.0, 5.0), (12, 1.0, 1.0), (13, 1.0, 1.0)], FEATURES)
    found = spark.createDataFrame(
        [(1, "x", 9, "", "", ""), (1, "x", 10, "", "", ""), (2, "y", 11, "", "", ""), (3, "", 12, "", "", ""), (4, None, 13, "", "", "")], MAP)
    got = rollup.artist_rollup(features, found)
    assert got.columns == ["artist_id", "artist", "recording_count", "a", "b"]
    assert sorted(map(tuple, got.collect())) == [(1, "x", 2, 2.0, 2.0), (2, "y", 1, 5.0, 5.0)]
    listed = rollup.artist_recordings(rollup.map_recordings(features, found))
    assert sorted(map(tuple, listed.select("artist_id", "position", "musicnet_id").collect())) == [(1, 1, 10), (1, 2, 9), (2, 1, 11)]


def test_rollup_counts_rows_and_lists_distinct_ids(spark):
    features = spark.createDataFrame([(9, 1.0, 1.0), (9, 3.0, 1.0)], FEATURES)
    got = rollup.artist_rollup(features, spark.createDataFrame([(1, "x", 9, "", "", "")], MAP)).first()
    assert (got["recording_count"], got["a"]) == (2, 2.0)


def test_repeated_recording_raises(spark):
    found = spark.createDataFrame([(1, "x", 9, "", "", ""), (2, "y", 9, "", "", "")], MAP)
    with pytest.raises(Exception, match="musicnet_id twice"):
        rollup.artist_rollup(spark.createDataFrame([(9, 1.0, 1.0)], FEATURES), found).collect()


def test_an_artist_with_half_of_all_recordings_is_one_row(spark):
    found = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("long").alias("artist_id"), F.lit("x").alias("artist"), F.col("id").alias("musicnet_id"))
    features = spark.range(4000).select(F.col("id").alias("musicnet_id"), F.col("id").cast("double").alias("a"))
    rows = rollup.artist_rollup(features, found).filter("artist_id = 1").collect()
    assert [r["recording_count"] for r in rows] == [2001] or [r["recording_count"] for r in rows] == [2000]
    listed = rollup.artist_recordings(rollup.map_recordings(features, found)).filter("artist_id = 1").orderBy("position").collect()
    assert [r["position"] for r in listed] == list(range(1, rows[0]["recording_count"] + 1))
    assert [str(r["musicnet_id"]) for r in listed] == sorted(str(r["musicnet_id"]) for r in listed)


def test_work_list(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "musicnet_id long")

    work = resume.work_list(ids(1, 2, 3, 4, 4), ids(2), ids(1, 1, 2, 4, 9))
    assert sorted(r[0] for r in resume.pending_ids(work).collect()) == [1, 4]
    assert sorted(r[0] for r in resume.missing_ids(work).collect()) == [3]


def wav(samples):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(22050)
        w.writeframes(np.asarray(samples, dtype="<i2").tobytes())
    return out.getvalue()


def loudness(content):
    with wave.open(io.BytesIO(content)) as w:
        samples = np.frombuffer(w.readframes(w.getnframes()), dtype="<i2").astype("float64")
    return {"peak": np.abs(samples).max(), "rms": math.sqrt((samples**2).mean())}


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "files"
    where.mkdir()
    for i in (1, 2, 3):
        (where / f"{i}.wav").write_bytes(wav([i, -i * 2, i]))
    (where / "4.wav").write_bytes(b"not audio")
    return where


def test_extraction(spark, folder):
    out = extract.extract_features(audio_files(spark, str(folder)), loudness, ["peak", "rms"])
    assert {r["musicnet_id"]: r["peak"] for r in extract.features_of(out).collect()} == {1: 2.0, 2: 4.0, 3: 6.0}
    failures = extract.failures_of(out).collect()
    assert [r["musicnet_id"] for r in failures] == [4] and failures[0]["error"].startswith("Error")


def test_extraction_as_stream_resumes(spark, folder, tmp_path):
    done, failed, checkpoint = (str(tmp_path / n) for n in ("done", "failed", "checkpoint"))

    def run():
        start_extraction(spark, str(folder), loudness, ["peak", "rms"], done, failed, checkpoint, files_per_batch=2).awaitTermination()
        return sorted(r["musicnet_id"] for r in spark.read.parquet(done).collect())

    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]
    (folder / "5.wav").write_bytes(wav([5]))
    assert run() == [1, 2, 3, 5]
    assert [r["musicnet_id"] for r in spark.read.parquet(failed).collect()] == [4]


def test_a_batch_run_again_adds_nothing(spark, folder, tmp_path):
    done, failed = str(tmp_path / "done"), str(tmp_path / "failed")
    (folder / "more").mkdir()
    (folder / "more" / "1.wav").write_bytes(wav([9]))
    files = spark.createDataFrame([(int(p.stem), str(p), p.read_bytes()) for p in sorted(folder.rglob("*.wav"))], "musicnet_id long, path string, content binary")
    none = spark.createDataFrame([], "musicnet_id long")
    chosen = extract.unprocessed(files, none, most=10)
    assert sorted(r["musicnet_id"] for r in chosen.select("musicnet_id").collect()) == [1, 2, 3, 4]
    batch = extract.extract_features(chosen, loudness, ["peak", "rms"]).cache()
    # The first run broke off after a part of its features.
    extract.features_of(batch).filter("musicnet_id = 2").write.parquet(done)
    for _ in range(2):
        extract.append_batch(batch, done, failed)
        assert sorted(r["musicnet_id"] for r in spark.read.parquet(done).collect()) == [1, 2, 3]
        assert [r["musicnet_id"] for r in spark.read.parquet(failed).collect()] == [4]


def test_extract_step_resumes(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    found = spark.createDataFrame([(1, "x", i, "", "", "") for i in (1, 2, 4, 8)], MAP)
    found.write.parquet(f"{out}/recording_map")
    for _ in range(2):
        prepare.extract_step(spark, str(folder), out, "train", loudness, ["peak", "rms"])
        assert {r["musicnet_id"]: r["peak"] for r in spark.read.parquet(f"{out}/audio_features_train").collect()} == {1: 2.0, 2: 4.0}
        assert [r["musicnet_id"] for r in spark.read.parquet(f"{out}/failures_train").collect()] == [4]
        assert [r["musicnet_id"] for r in spark.read.parquet(f"{out}/missing_train").collect()] == [8]


def test_state_of_the_stream_keeps_ids_and_attempts(spark, folder, tmp_path):
    done, failed, checkpoint, before = (str(tmp_path / n) for n in ("done", "failed", "checkpoint", "before"))
    spark.createDataFrame([(3,)], "musicnet_id long").write.parquet(before)
    (folder / "[1] a{b}").mkdir()
    (folder / "[1] a{b}" / "8.wav").write_bytes(wav([8]))

    def run():
        start_stateful_extraction(spark, str(folder) + "/{.,*}", loudness, ["peak", "rms"], done, failed, checkpoint, before, files_per_batch=2, attempts=3).awaitTermination()
        found = read_batches(spark, done, feature_schema(["peak", "rms"])).collect()
        notes = spark.read.option("recursiveFileLookup", True).parquet(failed).collect()
        return sorted((r["musicnet_id"], r["peak"]) for r in found), sorted((r["musicnet_id"], r["attempt"]) for r in notes)

    features = [(1, 2.0), (2, 4.0), (8, 8.0)]
    found, notes = run()
    assert found == features and notes[0] == (4, 1)
    # A second file of a known id adds nothing; a new id does.
    (folder / "[1] a{b}" / "1.wav").write_bytes(wav([9]))
    (folder / "5.wav").write_bytes(wav([5]))
    for _ in range(3):
        found, notes = run()
    assert found == sorted([*features, (5, 5.0)]) and notes == [(4, 1), (4, 2), (4, 3)]


def test_a_note_read_twice_counts_once(spark, tmp_path):
    files, notes = str(tmp_path / "files"), str(tmp_path / "notes")
    schema = "musicnet_id long, path string, attempt int"

    def run(new, failures):
        for path, rows in ((files, new), (notes, failures)):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        out = str(tmp_path / "out")
        chosen = chosen_files(spark.readStream.schema(schema).parquet(files), spark.readStream.schema(schema).parquet(notes), None, 2)
        chosen.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.parquet(out).collect()))

    assert run([(1, "b", 0), (1, "a", 0), (None, "x", 0)], []) == [(1, "a", 1)]
    assert run([(1, "c", 0)], [(1, "a", 1)]) == [(1, "a", 1), (1, "a", 2)]
    assert run([], [(1, "a", 1), (1, "a", 2), (2, "q", 1)]) == [(1, "a", 1), (1, "a", 2)]
