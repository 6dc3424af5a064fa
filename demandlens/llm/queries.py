"""Registered queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from demandlens.llm import bitsliced, collocations, fim, passages, warc
from demandlens.llm.bitsliced import op8_bitsliced
from demandlens.llm.bpe import op10_byte_bpe
from demandlens.llm.collocations import op11_collocations
from demandlens.llm.fim import op13_fim
from demandlens.llm.lm import op12_lm_score
from demandlens.llm.mixing import op2_mixing
from demandlens.llm.passages import op7_passages
from demandlens.llm.pii import op3_pii
from demandlens.llm.quality import op6_quality
from demandlens.llm.sharding import op4_sharding
from demandlens.llm.simhash import op9_simhash
from demandlens.llm.urls import op5_urls
from demandlens.llm.warc import op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_pii": op3_pii,
    "op4_sharding": op4_sharding,
    "op5_urls": op5_urls,
    "op6_quality": op6_quality,
    "op7_passages": op7_passages,
    "op8_bitsliced": op8_bitsliced,
    "op9_simhash": op9_simhash,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_collocations": op11_collocations,
    "op12_lm_score": op12_lm_score,
    "op13_fim": op13_fim,
}

ORACLE_SQL = {
    "op1_warc": warc.ORACLE,
    "op7_passages": passages.ORACLE,
    "op8_bitsliced": bitsliced.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_fim": fim.ORACLE,
}
