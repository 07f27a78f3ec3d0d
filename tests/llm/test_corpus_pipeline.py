"""The corpus pipeline against a brute-force version of its stages, and the entry point without it."""

import base64
import hashlib
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import tiktoken
from cases import near_components
from conftest_sf import SF_SMALL, table
from test_groups import cut_by_hand
from test_scores import rules_by_hand

from payerlake.llm.quality import judge

ROOT = Path(__file__).resolve().parents[2]


def test_pipeline_equals_brute_force(spark):
    docs = table("documents", "doc_id, text")
    far = {r.doc_id for r in judge(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
           if not r.kept and not r.base_failed}
    docs = [(d, t) for d, t in docs if not rules_by_hand(t)[-1] and d not in far]
    docs = list(cut_by_hand(docs).items())
    group = near_components(docs, 80)
    docs = [(d, t) for d, t in docs if group[d] == d]
    bench = [b for _, b in table("benchmark", "item_id, text")]
    docs = [(d, t) for d, t in docs if not any(b in t for b in bench)]
    with open(public_tokenizers.path(corpus_pipeline.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == {d for d, _ in docs}
    for d, t in docs:
        ids = library.encode_ordinary(t)
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages_keep_the_columns(spark):
    from cases import no_rows, odd_rows
    for df in (odd_rows(spark), no_rows(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF_SMALL)
            assert out.columns == df.columns
            assert out.count() <= df.count()
        assert corpus_pipeline.STAGES[-1][1](spark, df, SF_SMALL).count() == df.count()


def test_entry_point_without_this_subpackage():
    """The other queries stay when neither the subpackage nor the pipeline can be imported."""
    code = ("import sys, importlib.util as u; find = u.find_spec\n"
            "u.find_spec = lambda n, *a: None if n in ('payerlake.llm', 'corpus_pipeline') else find(n, *a)\n"
            "import __spark_entry__ as e; q = e.queries()\n"
            "assert q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q)\n"
            "assert set(e.oracle_sql()) <= set(q) and not any(m.startswith('payerlake.llm') for m in sys.modules)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
