"""The registered queries of the subpackage and their oracle SQL."""

from __future__ import annotations

from ledgerline.llm.byte_bpe import op4_byte_bpe
from ledgerline.llm.decontaminate import op6_decontaminate
from ledgerline.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from ledgerline.llm.line_dedup import OP3_SQL, op3_line_dedup
from ledgerline.llm.merkle import OP11_SQL, op11_merkle_manifest
from ledgerline.llm.ngram_join import op5_ngram_join
from ledgerline.llm.pii import op9_pii
from ledgerline.llm.quality import op8_quality
from ledgerline.llm.spot_signatures import op12_spot_signatures
from ledgerline.llm.token_files import op2_token_files
from ledgerline.llm.tokenizer_align import op13_tokenizer_align
from ledgerline.llm.toxicity import op7_toxicity
from ledgerline.llm.warc import op10_warc

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_files": op2_token_files,
    "op3_line_dedup": op3_line_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_ngram_join": op5_ngram_join,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_pii": op9_pii,
    "op10_warc": op10_warc,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spot_signatures": op12_spot_signatures,
    "op13_tokenizer_align": op13_tokenizer_align,
}

ORACLE_SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op3_line_dedup": OP3_SQL,
    "op11_merkle_manifest": OP11_SQL,
}
