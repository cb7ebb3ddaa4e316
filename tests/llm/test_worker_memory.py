"""What a worker process keeps between tasks goes when it does other work."""

import weakref

import numpy as np
import pyarrow as pa
import pytest

from tillstream.llm import quality, simhash, tokens

_TEXTS = pa.array(["some words here", None])


def _fingerprints():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), _TEXTS], ["doc_id", "text"])
    list(simhash._fingerprint_batches(iter([batch])))


def _training():
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), _TEXTS], ["label", "text"])
    list(quality._statistics_batches(iter([batch])))


def _scoring():
    quality._probabilities(quality.fit(np.eye(quality.FEATURES), np.arange(quality.FEATURES) % 2), _TEXTS)


@pytest.mark.parametrize("work", [_fingerprints, _training, _scoring])
def test_other_work_frees_the_encoder(work):
    encoder = tokens.encoder(tokens.path())
    assert tokens.encoder(tokens.path()) is encoder
    kept = weakref.ref(encoder)
    del encoder
    assert kept() is not None
    work()
    assert kept() is None
