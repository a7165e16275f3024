"""Column expressions; all evaluate inside the JVM (no Python per row)."""

from ledgerlink.functions.similarity import lcs_length, token_sort_ratio, token_sort_ratio_from_lcs  # noqa: F401
from ledgerlink.functions.text import (  # noqa: F401
    block_key, clean_name, list_size, normalize_address, parse_list, sort_tokens,
)
