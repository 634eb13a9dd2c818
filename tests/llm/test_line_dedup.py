"""Line de-duplication against a plain version of the same rule."""

import random
import re

import numpy as np
import pyarrow as pa

from cartwheel.llm import line_dedup as L
from cartwheel.llm import words


def described(text):
    data, offsets = words.text_bytes(pa.array([text]))
    starts, stops, counts, _ = L.lines_of(data, offsets)
    return words.hashes(data, starts, stops, fold=False), counts


def plain(docs):
    """{place in docs: (text, lines gone, words gone)} for (doc_id, text), by loops over lists."""
    order = sorted(range(len(docs)), key=lambda at: (docs[at][0] is None, docs[at][0] or 0, at))
    lines = {at: described(docs[at][1] or "") for at in order}
    first, prints = {}, {}
    for at in order:
        places, hashed = L.fingerprints(*lines[at])
        prints[at] = list(zip(places.tolist(), hashed.tolist()))
        for place, value in prints[at]:
            first.setdefault(value, (at, place))
    out = {}
    for at in order:
        own, gone = lines[at][0].tolist(), set()
        for place, value in prints[at]:
            other, there = first[value]
            if (other, there) == (at, place):
                continue
            theirs = lines[other][0].tolist()
            low = 0
            while place - low - 1 >= 0 and there - low - 1 >= 0 and own[place - low - 1] == theirs[there - low - 1]:
                low += 1
            high = 0
            while place + high < len(own) and there + high < len(theirs) and own[place + high] == theirs[there + high]:
                high += 1
            gone |= set(range(place - low, place + high))
        kept, number, lost = [], -1, 0
        for line in (docs[at][1] or "").split("\n"):
            if line.strip(" \t\n\v\f\r"):
                number += 1
                if number in gone:
                    lost += len(re.findall(r"[^\x20\x09-\x0D]+", line))
                    continue
            kept.append(line)
        out[at] = (None if docs[at][1] is None else "\n".join(kept), len(gone), lost)
    return out


def cleaned(df, texts):
    return {row.doc["at"]: (row.text, row.n_removed, row.words_removed) for row in L.dedup_lines(df).collect()}


def test_against_plain_version(spark):
    draw = random.Random(4)
    pool = [" ".join(f"w{draw.randrange(40)}" for _ in range(draw.choice([1, 3, 8, 20, 60]))) for _ in range(25)]
    docs = [(draw.choice([None, draw.randrange(100)]), "\n".join(draw.choice([*pool, "", "  "]) for _ in range(draw.randrange(0, 14)))) for _ in range(80)]
    docs = [(number, at, text) for at, (number, text) in enumerate(docs)]
    df = spark.createDataFrame(docs, "doc_id bigint, at bigint, text string").coalesce(1)
    expected = plain([(number, text) for number, _, text in docs])
    assert cleaned(df, docs) == expected
    assert sum(gone for _, gone, _ in expected.values()) > 20


def test_shared_runs_of_fifty_words_share_a_fingerprint():
    draw = random.Random(6)
    for _ in range(60):
        run = []
        while sum(len(line.split()) for line in run) < L.RUN_WORDS:
            run.append(" ".join(f"r{draw.randrange(1000)}" for _ in range(draw.randrange(1, 30))))
        texts = ["\n".join([*(f"own {draw.random()}" for _ in range(draw.randrange(6))), *run, *(f"end {draw.random()}" for _ in range(draw.randrange(6)))]) for _ in range(2)]
        one, two = (set(L.fingerprints(*described(text))[1].tolist()) for text in texts)
        assert one & two


def test_later_copies_of_a_passage_go_and_short_lines_stay(spark):
    passage = "\n".join(" ".join(f"p{line}{k}" for k in range(15)) for line in range(5))
    docs = [(3, 0, f"a b c\n{passage}\nlast"), (1, 1, f"{passage}\nx"), (2, 2, "Released under the MIT License.\ny"), (4, 3, "Released under the MIT License.\nz")]
    got = cleaned(spark.createDataFrame(docs, "doc_id bigint, at bigint, text string").coalesce(1), docs)
    assert got[0] == ("a b c\nlast", 5, 75)
    assert [got[at][0] for at in (1, 2, 3)] == [docs[at][2] for at in (1, 2, 3)]


def test_a_run_repeated_within_one_text(spark):
    line = " ".join(f"w{k}" for k in range(30))
    got = cleaned(spark.createDataFrame([(1, 0, "\n".join([line] * 4))], "doc_id bigint, at bigint, text string"), None)
    assert got[0] == (line, 3, 90)


def test_odd_documents(odd_docs, no_docs, odd_texts):
    rows = L.dedup_lines(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    expected = plain([(row.doc_id, row.text) for row in odd_docs.collect()])
    key = lambda found: sorted(map(repr, found))
    assert key((r.text, r.n_removed, r.words_removed) for r in rows) == key(expected.values())
    assert L.dedup_lines(no_docs).collect() == []


def test_extension_stops_at_the_first_other_line():
    own = np.array([9, 1, 2, 3, 8], dtype=np.uint64)
    other = np.array([1, 2, 3, 4], dtype=np.uint64)
    assert L.extended(own, other, -1, [2]) == [(1, 4)]
