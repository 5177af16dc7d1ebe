"""Suffix order of long and repetitive texts, and the work it takes."""

import random
import sys

import numpy as np
import pytest

from scorewatch.llm import suffix_array


def shard(n):
    """Pieces of a few passages, as the shards of the repeats hold them."""
    rng = random.Random(11)
    words = ["alpha", "béta", "gamma", "delta", "the", "of", "and", "ü"]
    passages = [" ".join(rng.choices(words, k=40)).encode() for _ in range(20)]
    data = b""
    while len(data) < n:
        passage = rng.choice(passages)
        data += passage[rng.randint(0, 60) :] + b"\x00"
    return np.concatenate([np.frombuffer(data[:n], np.uint8).astype(np.int64) + 1, [0]])


def lines_run(work):
    """Python lines of the module that a call runs."""
    count = 0

    def trace(frame, event, _):
        nonlocal count
        if frame.f_code.co_filename != suffix_array.__file__:
            return None
        count += event == "line"
        return trace

    before = sys.gettrace()
    sys.settrace(trace)
    try:
        work()
    finally:
        sys.settrace(before)
    return count


@pytest.mark.parametrize("text", [shard(60_000), np.append(np.full(20_000, 5), 0)], ids=["passages", "one symbol"])
def test_no_work_item_by_item(text):
    """Suffixes are placed by whole arrays, also those of reduced or uniform strings."""
    assert lines_run(lambda: suffix_array.suffix_array(text, 258)) < 1_000


@pytest.mark.parametrize(
    "text",
    [shard(4_000), np.append(np.full(3_000, 257), 0), np.append(np.tile(np.arange(1, 52), 60), 0), np.zeros(1, np.int64)],
    ids=["passages", "one symbol", "period", "empty"],
)
def test_order_of_repetitive_texts(text):
    items = text.tolist()
    order = suffix_array.suffix_array(text, 258)
    assert order.tolist() == sorted(range(len(items)), key=lambda i: items[i:])
