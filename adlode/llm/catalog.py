"""The registered queries of this package and their SQL."""

import corpus_pipeline
from adlode.llm import bpe, chat, html_crf, importance, jaccard, langid, mixing, outliers, packing, records, topk, toxicity, whitening

QUERIES = {
    "op1_html_article": html_crf.query,
    "op2_mix_sources": mixing.query,
    "op3_toxicity_cnn": toxicity.query,
    "op4_string_kernel_lang": langid.query,
    "op5_token_records": records.query,
    "op6_robust_outliers": outliers.query,
    "op7_chat_format": chat.query,
    "op8_jaccard_groups": jaccard.query,
    "op9_forced_boundary_bpe": bpe.query,
    "op10_exact_topk": topk.query,
    "op11_whitening": whitening.query,
    "op12_importance_resample": importance.query,
    "op13_nnls_packing": packing.query,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op2_mix_sources": mixing.SQL, "op7_chat_format": chat.SQL, "op10_exact_topk": topk.SQL,
           "op12_importance_resample": importance.SQL}
