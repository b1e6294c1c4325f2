"""What a worker takes for one text of 50 MB, the text itself included."""

import subprocess
import sys
from pathlib import Path

import pytest

BODY = """
import io, resource, sys
import numpy as np, pyarrow as pa
rnd = np.random.default_rng(1)
vocabulary = [bytes(rnd.integers(97, 123, rnd.integers(1, 10)).astype(np.uint8)) for _ in range(5000)]
out = io.BytesIO()
while out.tell() < 50_000_000:
    out.write(b" ".join(vocabulary[i] for i in rnd.integers(0, 5000, 1000)) + b"\\n")
raw = pa.py_buffer(out.getvalue())
del out
text = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, raw.size], np.int64)), raw).cast(pa.string())
batch = pa.RecordBatch.from_arrays([pa.array([1]), text], ["doc_id", "text"])
"""
OPERATORS = {
    "quality": ("from attesta.llm.quality import AttentionModel, scores_of; list(scores_of(text, AttentionModel(1)))", 260),
    "decontamination": ("from attesta.llm.decontam import ItemIndex, _hits; list(_hits(text, ItemIndex([1], ['a b c d e f g'])))", 340),
    "signatures": ("from attesta.llm.neardup import _sign; list(_sign([batch], 24, 4))", 340),
    "tokens": ("import public_tokenizers; from attesta.llm._bpe import Tokenizer; from attesta.llm._hash import token_parts; model = Tokenizer(public_tokenizers.path('byte_bpe_50k.json')); any(model.run(raw, offsets) and False for _, raw, offsets, _ in token_parts(text))", 260),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_long_text_takes_bounded_memory(name):
    code, most = OPERATORS[name]
    root = str(Path(__file__).resolve().parents[2])
    said = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {root!r})\n{BODY}\n{code}\nprint(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"], capture_output=True, text=True, timeout=300, env={**__import__("os").environ, "OMP_NUM_THREADS": "1"})
    assert said.returncode == 0, said.stderr[-2000:]
    assert int(said.stdout) < most
