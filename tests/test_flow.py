"""Raw files to prepared tables, step by step."""

import pytest

from tastegrid.plans import prepare


@pytest.fixture
def folders(tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    names = ["Brahms", "Bach", "The  Band", "ABBA", "Duo", "Duo"]
    (raw / "artists.dat").write_text(
        "id\tname\turl\tpictureURL\n" + "".join(f"{i}\t{n}\thttp://a/{i}\tp\n" for i, n in enumerate(names, 1)) + "7\ttoo\tmany\tfields\there\n")
    (raw / "user_artists.dat").write_text(
        "userID\tartistID\tweight\n" + "".join(f"{u}\t{a}\t{u * a * 10}\n" for u in range(1, 6) for a in range(1, 7)) + "9\t1\t4\n9\t99\t5\n")
    (raw / "tags.dat").write_bytes("tagID\ttagValue\n1\tClassical\n2\tcafé pop\n3\tpop\n".encode("iso-8859-1"))
    (raw / "user_taggedartists.dat").write_text(
        "userID\tartistID\ttagID\tday\tmonth\tyear\n" + "".join(f"{u}\t{a}\t{t}\t1\t1\t2009\n" for u in (1, 2) for a in (1, 2, 4) for t in (1, 2, 3) if (u + a + t) % 2))
    (raw / "recordings.csv").write_text('id,composer,note\n10,Brahms,"x, y"\n11,Brahms,\n12,"Bach, Johann Sebastian",z\n13,Duo,\n')
    return str(raw), str(out)


def test_flow(spark, folders):
    raw, out = folders
    prepare.catalog_step(spark, raw, out)
    prepare.ratings_step(spark, raw, out)
    prepare.split_step(spark, out)
    prepare.overlap_step(spark, out)
    prepare.master_step(spark, out)
    prepare.tag_step(spark, raw, out)
    features = f"{out}/audio_features"
    spark.createDataFrame([(10, 1.0), (11, 3.0), (12, 5.0)], "musicnet_id long, tempo double").write.parquet(features)
    for which in ("train", "test"):
        prepare.artist_audio_step(spark, features, out, which)

    catalog = {r["artist_id"]: (r["artist"], r["musicnet_id"]) for r in spark.read.parquet(f"{out}/catalog").collect()}
    assert catalog == {1: ("brahms", 10), 2: ("bach", 12), 3: ("the band", None), 4: ("abba", None), 5: ("duo", None), 6: ("duo", None)}
    found = {r["musicnet_id"]: (r["artist_id"], r["match_type"]) for r in spark.read.parquet(f"{out}/recording_map").collect()}
    assert found == {10: (1, "exact"), 11: (1, "exact"), 12: (2, "alias")}
    assert spark.read.parquet(f"{out}/ratings").count() == 31
    assert prepare.train_table(spark, out).count() == 26 and prepare.test_table(spark, out).count() == 5
    assert spark.read.parquet(f"{out}/master").columns == ["user_id", "artist_id", "artist", "rating", "url", "musicnet_id"]
    audio = {r["artist_id"]: (r["recording_count"], r["tempo"]) for r in spark.read.parquet(f"{out}/artist_audio_train").collect()}
    assert audio == {1: (2, 2.0), 2: (1, 5.0)}
    listed = spark.read.parquet(f"{out}/artist_recordings_train").orderBy("artist_id", "position").collect()
    assert [(r["artist_id"], r["position"], r["musicnet_id"]) for r in listed] == [(1, 1, 10), (1, 2, 11), (2, 1, 12)]
    report = prepare.report_step(spark, out)
    assert report.filter("not passed").isEmpty() and report.count() == 29


def test_flow_without_recordings(spark, folders, tmp_path):
    raw, out = folders
    (tmp_path / "raw" / "recordings.csv").rename(tmp_path / "elsewhere.csv")
    prepare.catalog_step(spark, raw, out)
    assert spark.read.parquet(f"{out}/recording_map").isEmpty()
    assert {r["musicnet_id"] for r in spark.read.parquet(f"{out}/catalog").collect()} == {None}
    failed = {(r["rule_id"], r["table_name"]) for r in prepare.report_step(spark, out).filter("not passed").collect()}
    assert ("V25", "ratings") in failed and ("V25", "test") in failed
