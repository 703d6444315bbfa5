"""The operators' queries and, where SQL can express one, its DuckDB SQL."""

from ledgerlens.llm.op1_simhash import op1_simhash
from ledgerlens.llm.op2_substring import OP2_SQL, op2_substring
from ledgerlens.llm.op3_exact import OP3_SQL, op3_exact
from ledgerlens.llm.op4_mix import OP4_SQL, op4_mix
from ledgerlens.llm.op5_chat import OP5_SQL, op5_chat
from ledgerlens.llm.op6_lines import OP6_SQL, op6_lines
from ledgerlens.llm.op7_toxicity import op7_toxicity
from ledgerlens.llm.op8_quality import op8_quality
from ledgerlens.llm.op9_langid import op9_langid
from ledgerlens.llm.op10_decontam import OP10_SQL, op10_decontam
from ledgerlens.llm.op11_html import op11_html
from ledgerlens.llm.op12_centroids import OP12_SQL, op12_centroids
from ledgerlens.llm.op13_lexical import OP13_SQL, op13_lexical

QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_substring, op3_exact, op4_mix, op5_chat, op6_lines, op7_toxicity,
    op8_quality, op9_langid, op10_decontam, op11_html, op12_centroids, op13_lexical)}
ORACLE = {"op2_substring": OP2_SQL, "op3_exact": OP3_SQL, "op4_mix": OP4_SQL, "op5_chat": OP5_SQL,
          "op6_lines": OP6_SQL, "op10_decontam": OP10_SQL, "op12_centroids": OP12_SQL,
          "op13_lexical": OP13_SQL}
