import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from touchline.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, chunk string, blob int, bucket int"


def brute(rows):
    """Set of all 50-byte strings of smaller documents, one position after another."""
    seen, out = {}, []
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            seen.setdefault(raw[i : i + 50], doc)
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 49):
            if doc is not None and seen[raw[i : i + 50]] < doc:
                gone[i : i + 50] = True
        n_spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        out.append((doc, len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, chunk=sd.CHUNK):
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA).repartition(3)
    got = sd.remove_repeats(df, chunk).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=str)


def made_rows():
    r = random.Random(5)
    passages = ["".join(r.choice("abcé ") for _ in range(n)) for n in (49, 50, 51, 75, 120, 400)]
    rows = [(None, passages[-1]), (0, None), (1, ""), (2, "a" * 300), (3, "ab" * 200), (4, "a" * 49), (5, "a" * 50)]
    for i in range(6, 60):
        parts = [r.choice(passages) if r.random() < 0.5 else "".join(r.choice("abcé ") for _ in range(r.randint(1, 90))) for _ in range(r.randint(1, 6))]
        rows.append((i, "".join(parts)))
    return rows + [(20, rows[26][1]), (20, rows[26][1]), (61, "".join(passages) * 40)]


@pytest.mark.parametrize("chunk", [sd.CHUNK, 700, 1])
def test_equals_brute_force(spark, chunk):
    rows = made_rows()
    assert result(spark, rows, chunk) == brute(rows)


def test_hot_passage_and_empty_table(spark):
    line = "The quick brown fox jumps over the lazy dog and runs away again. "
    rows = [(i, f"{i * 7919} {line}{i * 104729}") for i in range(400)]
    assert result(spark, rows, 3000) == brute(rows)
    assert result(spark, []) == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.text(alphabet="ab", max_size=140)), max_size=8))
def test_low_entropy(spark, rows):
    assert result(spark, rows, 200) == brute(rows)
