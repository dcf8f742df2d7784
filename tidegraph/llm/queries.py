"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tidegraph.llm.ann import op8_ann_learned_partitions
from tidegraph.llm.bpe import op4_bpe
from tidegraph.llm.collocations import OP13_SQL, op13_collocations
from tidegraph.llm.extraction import op2_html_gbt
from tidegraph.llm.langid import op9_langid
from tidegraph.llm.minhash import OP12_SQL, op12_minhash
from tidegraph.llm.mixing import OP6_SQL, op6_poisson_mixing
from tidegraph.llm.negatives import OP11_SQL, op11_hard_negatives
from tidegraph.llm.pii import op1_pii
from tidegraph.llm.simhash import op10_simhash
from tidegraph.llm.sketch import op3_scaled_sketch
from tidegraph.llm.tools import OP7_SQL, op7_tool_linking
from tidegraph.llm.warc import op5_warc_derivatives

QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_html_gbt,
        op3_scaled_sketch,
        op4_bpe,
        op5_warc_derivatives,
        op6_poisson_mixing,
        op7_tool_linking,
        op8_ann_learned_partitions,
        op9_langid,
        op10_simhash,
        op11_hard_negatives,
        op12_minhash,
        op13_collocations,
    )
}
SQL = {
    "op6_poisson_mixing": OP6_SQL,
    "op7_tool_linking": OP7_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_minhash": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
