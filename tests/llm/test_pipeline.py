"""The pipeline against a brute-force version of its stages; and the library without the subpackage."""

import os
import shutil
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

from .test_search_and_quotes import brute_leaks
from .test_sets_and_windows import brute_components

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cut_windows(rows, n=20):
    first, words = {}, [(i, t.split()) for i, t in rows]
    out = []
    for i, w in sorted(words):
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            if first.setdefault(tuple(w[s:s + n]), (i, s)) != (i, s):
                gone[s:s + n] = [True] * n
        out.append((i, [x for x, g in zip(w, gone, strict=True) if not g], any(gone)))
    texts = dict(rows)
    return [(i, " ".join(w) if cut else texts[i]) for i, w, cut in out if w or not cut]


def expected(docs, items):
    kept = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    least = {i for i, _, c in brute_components(kept, 5, 80) if i == c}
    kept = cut_windows([(i, t) for i, t in kept if i in least])
    leaked = {d for d, *_ in brute_leaks(kept, items)}
    return [(i, t) for i, t in kept if i not in leaked]


def test_run_is_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = expected(docs, items)
    assert 0 < len(kept) < len(docs)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = Counter()
    for i, t in kept:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want.update((i, p, a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:])))
    got = Counter((r["doc_id"], r["piece"], r["start"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want


def test_stages_on_awkward_and_empty_tables(spark):
    from .cases import documents, frame
    docs = frame(spark, documents(seed=9)).select(*corpus_pipeline.COLUMNS)
    for table in (docs, docs.where("false")):
        for _, step in corpus_pipeline.STAGES[:-1]:
            table = step(spark, table, SF)
            assert tuple(table.columns) == corpus_pipeline.COLUMNS
        rows = corpus_pipeline.STAGES[-1][1](spark, table, SF).collect()
        assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)


def test_the_rest_imports_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q)"],
                          cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""}, check=True)
    n, has = said.stdout.split()[-2:]
    assert int(n) >= 100 and has == "False"
