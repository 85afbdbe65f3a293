"""Operator 10 goes on dealing anew for as long as that helps."""

import logging
import random

from sluice.llm import packing


def test_rounds_end_only_when_nothing_is_won(spark, monkeypatch, caplog):
    rnd, rounds, plain = random.Random(1), [], packing._round

    def counted(items, *rest):
        state = plain(items, *rest)
        rounds.append((state.filter("handed").count(), state.filter("gained").count()))
        return state

    monkeypatch.setattr(packing, "_round", counted)
    caplog.set_level(logging.INFO, packing.__name__)
    lengths = [rnd.randint(22, 60) for _ in range(1000)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").coalesce(1)
    rows = packing.pack(pieces, 100, 4).collect()
    assert len(rounds) > 6 and f"packed in {len(rounds)} rounds" in caplog.text and "without a certificate" in caplog.text
    (before, _), (left, gained) = rounds[-2:]
    assert before <= 4 or not left or not gained and left == before
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(r["doc_id"] for r in rows) == list(range(len(lengths)))
    for s in held.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 100


def test_carried_columns_come_with_their_pieces(spark):
    rnd = random.Random(2)
    rows = [(i % 7, rnd.randint(1, 100), bytes([i % 251]) * (i % 90)) for i in range(400)]
    pieces = spark.createDataFrame(rows, "doc_id long, length long, ids binary").repartition(4)
    got = packing.pack(pieces, 100, 50, carry=("ids",))
    assert got.columns == ["doc_id", "length", "ids", "sequence_id", "offset"]
    assert sorted((r["doc_id"], r["length"], bytes(r["ids"])) for r in got.collect()) == sorted(rows)
