"""What a worker of the token stage holds."""

from __future__ import annotations

import pyarrow as pa

from newsfunnel.llm import bpe
from newsfunnel.llm.common import slices, text_arrays, text_offsets


def test_slices_do_not_copy_the_text(monkeypatch):
    for kind in (pa.string(), pa.large_string()):
        col = pa.array(["x" * 9, None, "", "é中", "y" * 50, "z"] * 40, kind)
        for part in (col, col[3:77], col[:0]):
            at = text_offsets(part)
            assert (at - at[0]).tolist() == text_arrays(part)[1].tolist() if len(part) else not len(list(slices(pa.record_batch([part], ["t"]), "t")))
    monkeypatch.setattr("newsfunnel.llm.common.text_arrays", lambda *_: 1 / 0)
    batch = pa.record_batch([col], ["t"])
    parts = list(slices(batch, "t", 100))
    assert sum(p.num_rows for p in parts) == len(col) and pa.concat_arrays([p.column(0) for p in parts]).equals(col)


def test_borders_follow_the_memo():
    """A small memo keeps few known token borders, too."""
    class Vocabulary:
        border_entries = 0
        pattern = bpe.re.compile(r" ?\w+")

        def encode_pieces(self, pieces):
            return {p: [len(p)] for p in pieces}

    own = Vocabulary()
    bpe._Ids(own).prepare([["a", "b", "c"]], 100)
    assert own.border_entries == 100
    bpe._Ids(own).prepare([["a", "b", "c"]], 900_000)
    assert own.border_entries == 450_000
