"""Every sweep of the class exchange counts contexts under the classes of that sweep."""

import numpy as np

from matchlake.llm import class_lm

SF = "/root/testdata/sf0.01"


def test_contexts_are_the_current_classes_in_every_sweep(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CHUNK_BYTES", 400_000)
    monkeypatch.setattr(class_lm, "WORDS_PER_PART", 20_000)
    summed, found = class_lm._summed, []

    def kept(counts, size):
        found.append(summed(counts, size))
        return found[-1]

    monkeypatch.setattr(class_lm, "_summed", kept)
    class_lm.score_documents(spark.read.parquet(f"{SF}/documents.parquet"))
    classes, size = class_lm.CLASSES, (class_lm.SLOTS + 1) * class_lm.CLASSES
    values = []
    for one in found[: class_lm.SWEEPS]:
        before, after, sizes = np.split(one[:size].reshape(-1, classes), (classes, 2 * classes))
        # classes before, then classes after: the same pairs of classes, seen from both sides
        assert (before == after.T).all() and (before.sum(axis=0) == sizes[0]).all() and sizes.sum() > 100_000
        part = before[before > 0] * np.log(before[before > 0])
        values.append(part.sum() - 2 * (sizes[sizes > 0] * np.log(sizes[sizes > 0])).sum())
    assert len(values) == class_lm.SWEEPS and values == sorted(values)  # of the class bigrams themselves


def test_packed_numbers():
    for numbers in (np.arange(1), np.random.default_rng(3).integers(0, 1 << 31, 1000)):
        assert (class_lm._unpacked(class_lm._packed(numbers)) == numbers).all()
