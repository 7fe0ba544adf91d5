import io
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from adlens.llm import plane_files as pf
from adlens.llm import tokens


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("top", [1, 2, 255, 256, 49408, 2**32])
def test_planes_round_trip(bits, top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 7, 1000):
        ids = rng.integers(0, top, n).astype("<u4")
        assert (pf.from_planes(pf.to_planes(ids, bits), n, bits) == ids).all()


@pytest.mark.parametrize("bits", [True, False])
def test_file_round_trip(bits):
    rng = np.random.default_rng(0)
    docs = [(None if k == 3 else 10 * k - 5, rng.integers(0, 50000, rng.integers(0, 900)).astype("<u4")) for k in range(60)]
    data = b"".join(pf.Writer(block=256, bits=bits).write(docs))
    reader = pf.Reader(Bytes(data))
    whole = np.concatenate([ids for _, ids in docs])
    start = 0
    for (doc, ids), got in zip(docs, reader.documents(), strict=True):
        assert got == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    for a, b in ((0, 0), (0, 1), (250, 260), (500, 5000), (start - 3, start)):
        assert (reader.range(a, b) == whole[a:b]).all()
    with pytest.raises(ValueError):
        pf.Reader(Bytes(data[:-9]))


def test_round_trip_over_files(odd_docs, no_docs, spark):
    tok = Tokenizer.from_file(tokens.public_path())
    from pyspark.sql import functions as F
    ordered = odd_docs.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
    want, start = [], 0
    for r in ordered:
        ids = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in pf.round_trip(odd_docs, tokens.public_path()).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    key = lambda x: x[1]
    assert sorted(got, key=key) == want
    assert pf.round_trip(no_docs, tokens.public_path()).count() == 0
