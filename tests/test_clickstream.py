import datetime as dt

import pytest

from cartwheel.model import CLICK_FILE_DDL, STAMP, STAMP_DATE
from cartwheel.sources.files import click_files, parquet
from cartwheel.streaming import clickstream

COLUMNS = [field.split()[0] for field in CLICK_FILE_DDL.split(", ")]


def line(event_id, *, time_text="2024-01-01 10:00:00", returning="True", read="null", url="https://x.example/"):
    values = dict.fromkeys(COLUMNS, "")
    values |= {
        "event_id": event_id, "user_id": 7, "event_type": "view", "event_time": time_text, "page_url": url,
        "price": 1.5, "is_returning": returning, "is_read": read,
    }
    return ",".join(str(values[name]) for name in COLUMNS) + "\n"


@pytest.fixture
def landing(tmp_path):
    place = tmp_path / "landing"
    place.mkdir()
    return place


@pytest.fixture
def ingest(spark, landing, folder):
    def run():
        clickstream.ingest_once(spark, str(landing), f"{folder}/raw", f"{folder}/checkpoint")
        return parquet(spark, f"{folder}/raw")

    return run


def ids(df):
    return sorted(row.event_id for row in df.select("event_id").collect())


def test_stream_equals_batch_and_reruns_add_nothing(spark, landing, ingest):
    (landing / "a.csv").write_text(line(1) + line(2, read="2024-01-01 00:00:00") + line(3, read=""))
    (landing / "b.csv").write_text(line(4, returning="", time_text="soon", read="NULL"))
    (landing / "notes.txt").write_text(line(9))
    found = ingest()
    batch = clickstream.shape(click_files(spark, str(landing)))
    key = lambda row: row.event_id
    plain = found.drop(STAMP, STAMP_DATE)
    assert sorted(plain.collect(), key=key) == sorted(batch.drop(STAMP).collect(), key=key)
    assert ids(found) == [1, 3, 4]
    assert ids(ingest()) == [1, 3, 4]
    (landing / "c.csv").write_text(line(5))
    assert ids(ingest()) == [1, 3, 4, 5]


def test_shape(spark, landing, ingest):
    (landing / "a.csv").write_text(
        line(1, returning="TRUE", url='"https://x.example/?a=1,2"') + line(2, returning="yes", time_text="soon")
    )
    one, two = sorted(ingest().collect(), key=lambda row: row.event_id)
    assert (one.event_time, one.is_returning, one.page_url) == (
        dt.datetime(2024, 1, 1, 10), True, "https://x.example/?a=1,2",
    )
    assert (two.event_time, two.is_returning, two.session_id) == (None, False, None)
    assert isinstance(one[STAMP], dt.datetime)


def test_continuous(spark, landing, folder):
    for name in ("a", "b", "c"):
        (landing / f"{name}.csv").write_text(line(ord(name)))
    query = clickstream.start(
        spark, str(landing), f"{folder}/raw", f"{folder}/checkpoint", continuous=True, interval="0 seconds"
    )
    try:
        query.processAllAvailable()
        rows = [progress["numInputRows"] for progress in query.recentProgress if progress["numInputRows"]]
        assert rows == [1, 1, 1]
    finally:
        query.stop()
    assert ids(parquet(spark, f"{folder}/raw")) == [97, 98, 99]


def test_growing_file(spark, landing, folder):
    file = landing / "clicks.csv"
    file.write_text(line(1) + line(2))
    assert clickstream.ingest_batch(spark, str(file), f"{folder}/raw")
    assert not clickstream.ingest_batch(spark, str(file), f"{folder}/raw")
    file.write_text(line(1) + line(2) + line(3) + line(3))
    assert clickstream.ingest_batch(spark, str(landing), f"{folder}/raw")
    assert ids(parquet(spark, f"{folder}/raw")) == [1, 2, 3]


def test_growing_file_lands_the_same_rows_in_one_load_and_in_two(spark, landing, folder):
    file = landing / "clicks.csv"
    first, second = line(1) + line(1) + line(2).replace("2,", ",", 1), line(2) + line(2) + line(3).replace("3,", ",", 1)
    file.write_text(first)
    assert clickstream.ingest_batch(spark, str(file), f"{folder}/two")
    file.write_text(first + second)
    assert clickstream.ingest_batch(spark, str(file), f"{folder}/two")
    assert not clickstream.ingest_batch(spark, str(file), f"{folder}/two")
    assert clickstream.ingest_batch(spark, str(file), f"{folder}/one")
    content = [sorted(map(repr, parquet(spark, f"{folder}/{name}").drop(STAMP, "_ingestion_date").collect())) for name in ("one", "two")]
    assert content[0] == content[1]
    assert sum("event_id=None" in row for row in content[0]) >= 1 and len(content[0]) == len(set(content[0]))


def test_file_without_unread_rows(spark, landing, folder):
    (landing / "clicks.csv").write_text("")
    assert not clickstream.ingest_batch(spark, str(landing), f"{folder}/raw")


def test_stream_and_batch_do_not_share_a_folder(spark, landing, folder, ingest):
    (landing / "a.csv").write_text(line(1))
    ingest()
    (landing / "b.csv").write_text(line(2))
    with pytest.raises(ValueError):
        clickstream.ingest_batch(spark, str(landing), f"{folder}/raw")
    assert clickstream.ingest_batch(spark, str(landing), f"{folder}/other")
    with pytest.raises(ValueError):
        clickstream.start(spark, str(landing), f"{folder}/other", f"{folder}/checkpoint2")
