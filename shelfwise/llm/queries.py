"""Registry of the training-data queries and of the SQL that checks them."""

from __future__ import annotations

from shelfwise.llm.best_fit_packing import op6_best_fit_packing
from shelfwise.llm.chat_windows import ORACLE_SQL as CHAT_WINDOWS_SQL
from shelfwise.llm.chat_windows import op7_chat_windows
from shelfwise.llm.embedding_caps import ORACLE_SQL as EMBEDDING_CAPS_SQL
from shelfwise.llm.embedding_caps import op3_embedding_caps
from shelfwise.llm.license_scan import op1_license_scan
from shelfwise.llm.line_quality import ORACLE_SQL as LINE_QUALITY_SQL
from shelfwise.llm.line_quality import op5_line_quality
from shelfwise.llm.minhash_dedup import ORACLE_SQL as MINHASH_DEDUP_SQL
from shelfwise.llm.minhash_dedup import op2_minhash_dedup
from shelfwise.llm.pii_disclosure import op10_pii_disclosure
from shelfwise.llm.quality_gam import op9_quality_gam
from shelfwise.llm.source_mixing import op4_source_mixing
from shelfwise.llm.spelling_groups import ORACLE_SQL as SPELLING_GROUPS_SQL
from shelfwise.llm.spelling_groups import op11_spelling_groups
from shelfwise.llm.url_filter import op8_url_filter
from shelfwise.llm.warc_zstd import ORACLE_SQL as WARC_ZSTD_SQL
from shelfwise.llm.warc_zstd import op13_warc_zstd
from shelfwise.llm.whitening import op12_embedding_whitening

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_embedding_caps": op3_embedding_caps,
    "op4_source_mixing": op4_source_mixing,
    "op5_line_quality": op5_line_quality,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_chat_windows": op7_chat_windows,
    "op8_url_filter": op8_url_filter,
    "op9_quality_gam": op9_quality_gam,
    "op10_pii_disclosure": op10_pii_disclosure,
    "op11_spelling_groups": op11_spelling_groups,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_warc_zstd": op13_warc_zstd,
}

ORACLE_SQL: dict[str, str] = {
    "op2_minhash_dedup": MINHASH_DEDUP_SQL,
    "op3_embedding_caps": EMBEDDING_CAPS_SQL,
    "op5_line_quality": LINE_QUALITY_SQL,
    "op7_chat_windows": CHAT_WINDOWS_SQL,
    "op11_spelling_groups": SPELLING_GROUPS_SQL,
    "op13_warc_zstd": WARC_ZSTD_SQL,
}
