import tracemalloc

from tickloom.llm import line_edits


def test_short_and_very_long_pairs_are_padded_apart():
    left = ["abcdefgh" * 25] * 2000 + ["a" * 60_000] * 40 + ["", "b"]
    right = ["abcdefgh" * 25] * 1000 + ["abcdefgx" * 25] * 1000 + ["a" * 59_998] * 20 + ["a" * 59_990] * 20 + ["bb", ""]
    tracemalloc.start()
    got = line_edits.near_pairs(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.tolist() == [True] * 1000 + [False] * 1000 + [True] * 20 + [False] * 20 + [True] * 2
    assert peak < 200 << 20
