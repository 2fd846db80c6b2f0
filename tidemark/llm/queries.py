"""The registered query of each operator, and the SQL that has to agree where SQL can express it."""

from tidemark.llm import (
    centroids,
    chat,
    exact_dedup,
    hilbert,
    html_text,
    lattice,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    substrings,
    toxicity,
    whitening,
)

QUERIES = {
    "op1_suffix_dedup": substrings.op1_suffix_dedup,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_packing": packing.op3_packing,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_chat": chat.op5_chat,
    "op6_html": html_text.op6_html,
    "op7_hilbert": hilbert.op7_hilbert,
    "op8_lattice": lattice.op8_lattice,
    "op9_mixing": mixing.op9_mixing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_shallot": centroids.op11_shallot,
    "op12_whitening": whitening.op12_whitening,
    "op13_line_dedup": line_dedup.op13_line_dedup,
}
ORACLES = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op5_chat": chat.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_shallot": centroids.ORACLE,
    "op13_line_dedup": line_dedup.ORACLE,
}
