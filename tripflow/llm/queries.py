"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from tripflow.llm import common


def queries() -> dict:
    from tripflow.llm.collocations import op13_collocations
    from tripflow.llm.embedding_dedup import op8_cap_filters
    from tripflow.llm.minhash import op10_dart_minhash
    from tripflow.llm.mixing import op11_mixing
    from tripflow.llm.neighbours import op3_multi_index
    from tripflow.llm.packing import op7_packing
    from tripflow.llm.pii import op5_pii
    from tripflow.llm.quality import op6_kneser_ney
    from tripflow.llm.search import op12_term_pipeline
    from tripflow.llm.secret_scan import op9_secret_scan
    from tripflow.llm.segmentation import op4_sampled_pieces
    from tripflow.llm.sharding import op2_jump_shards
    from tripflow.llm.token_files import op1_token_files
    found = [op1_token_files, op2_jump_shards, op3_multi_index, op4_sampled_pieces, op5_pii, op6_kneser_ney,
             op7_packing, op8_cap_filters, op9_secret_scan, op10_dart_minhash, op11_mixing, op12_term_pipeline, op13_collocations]
    return {f.__name__: _prepared(f) for f in found} | {"pipeline": _prepared(corpus_pipeline.run)}


def _prepared(fn):
    def run(spark, sf_dir):
        common.prepare(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    return run


def oracle_sql() -> dict[str, str]:
    from tripflow.llm.collocations import OP13_SQL
    from tripflow.llm.embedding_dedup import OP8_SQL
    from tripflow.llm.mixing import OP11_SQL
    from tripflow.llm.search import OP12_SQL
    return {"op8_cap_filters": OP8_SQL, "op11_mixing": OP11_SQL, "op12_term_pipeline": OP12_SQL,
            "op13_collocations": OP13_SQL}
