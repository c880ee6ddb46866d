"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tickbars.llm.op1_quality import op1_quality
from tickbars.llm.op2_exact_dedup import OP2_SQL, op2_exact_dedup
from tickbars.llm.op3_packing import op3_packing
from tickbars.llm.op4_suffix_dedup import op4_suffix_dedup
from tickbars.llm.op5_language import op5_language
from tickbars.llm.op6_url_filter import OP6_SQL, op6_url_filter
from tickbars.llm.op7_simhash import op7_simhash
from tickbars.llm.op8_substring_dedup import op8_substring_dedup
from tickbars.llm.op9_archives import OP9_SQL, op9_archives
from tickbars.llm.op10_mixing import OP10_SQL, op10_mixing
from tickbars.llm.op11_conversations import OP11_SQL, op11_conversations
from tickbars.llm.op12_search import OP12_SQL, op12_search
from tickbars.llm.op13_token_counts import op13_token_counts

QUERIES = {
    "op1_quality": op1_quality,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_language": op5_language,
    "op6_url_filter": op6_url_filter,
    "op7_simhash": op7_simhash,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_archives": op9_archives,
    "op10_mixing": op10_mixing,
    "op11_conversations": op11_conversations,
    "op12_search": op12_search,
    "op13_token_counts": op13_token_counts,
}

ORACLE = {
    "op2_exact_dedup": OP2_SQL,
    "op6_url_filter": OP6_SQL,
    "op9_archives": OP9_SQL,
    "op10_mixing": OP10_SQL,
    "op11_conversations": OP11_SQL,
    "op12_search": OP12_SQL,
}
