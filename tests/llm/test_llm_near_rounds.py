"""What keeps the near copies' disk small leaves out nothing."""

import numpy as np

from starloom.llm.edit_embedding import (
    ROUNDS,
    TAIL,
    _tails,
    _unpacked,
    as_text,
    band_keys,
    likeness,
    may_be_alike,
    sampled_steps,
)
from starloom.workspace import Workspace


def test_rounds_share_all_bands():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 31, 33, 64, 150, 301):
        digits = rng.integers(0, 16, n).astype(np.uint8)
        parts = [band_keys(digits, 0.8, turn, ROUNDS) for turn in range(ROUNDS)]
        assert sorted(np.concatenate(parts).tolist()) == sorted(band_keys(digits, 0.8).tolist())


def test_tails_keep_every_alike_pair(spark):
    rng, prints = np.random.default_rng(5), []
    for n in [1, 2, 5, 20, 31, 32, 33, 40, 63, 64, 65, 100, 140, 200] * 3:
        one = rng.integers(0, 16, n).astype(np.uint8)
        prints.append(one)
        for longer, changed in ((0, 1), (1, 2), (4, 3), (9, 0), (0, n // 4)):
            other = np.concatenate((one, rng.integers(0, 16, longer).astype(np.uint8)))
            other[rng.integers(0, len(other), changed)] = 0
            prints.append(other)
    rows = [(i, as_text(p)) for i, p in enumerate(prints)]
    found = _tails(spark.createDataFrame(rows, "node long, print string").coalesce(1)).orderBy("node").toArrow()
    n, tails = found.column("n").to_numpy().astype(np.int64), _unpacked(found.column("tail"))
    assert tails.shape[1] == TAIL and n.tolist() == [len(p) for p in prints]
    alike = chance = 0
    for i, one in enumerate(prints):
        may = may_be_alike(np.full(len(n), n[i]), np.repeat(tails[i : i + 1], len(n), 0), n, tails, 0.8)
        for j, other in enumerate(prints):
            if likeness(one, other) >= 0.8:
                alike += 1
                assert may[j]
            else:
                chance += not may[j]
    assert alike > len(prints) and chance > len(prints) and len(sampled_steps()[0]) > 200


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    def shuffled():
        root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(str(f.getName()).startswith("shuffle_") for f in _seq(root.getAllFiles()))

    def _seq(files):
        return [files.apply(i) for i in range(files.size())]

    scratch, before = Workspace(spark, f"file://{tmp_path}"), shuffled()
    saved = scratch.save_and_release(spark.range(1000).repartition(3, "id"), "rows")
    assert shuffled() <= before and saved.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") in ("false", None)
