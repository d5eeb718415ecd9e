"""The subpackage's queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from .chat import OP8_SQL, op8_chat_format
from .divergence import OP11_SQL, op11_source_divergence
from .embed_dedup import op6_imi_dedup
from .html_text import op9_main_text
from .merkle import OP13_SQL, op13_merkle_manifest
from .minhash import op3_minmax_dedup
from .mixing import OP1_SQL, op1_mix_sources
from .oracles import OP3_SQL, OP6_SQL, OP7_SQL
from .packing import op10_pack
from .secret_scan import op2_secret_scan
from .sharding import op4_kd_shards
from .toxicity import op5_toxicity
from .vptree import op7_vp_search
from .warc_zip import OP12_SQL, op12_warc_zip

QUERIES = {f.__name__: f for f in (  # by number
    op1_mix_sources, op2_secret_scan, op3_minmax_dedup, op4_kd_shards, op5_toxicity, op6_imi_dedup, op7_vp_search, op8_chat_format, op9_main_text, op10_pack, op11_source_divergence, op12_warc_zip, op13_merkle_manifest,
)}
SQL = {"op1_mix_sources": OP1_SQL, "op3_minmax_dedup": OP3_SQL, "op6_imi_dedup": OP6_SQL, "op7_vp_search": OP7_SQL, "op8_chat_format": OP8_SQL, "op11_source_divergence": OP11_SQL, "op12_warc_zip": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
