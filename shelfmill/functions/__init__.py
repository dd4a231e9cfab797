"""Column functions. All are built-in expressions; no Python runs per row."""

from .colors import color_from_name, color_from_phrase, is_bad_color
from .prices import (
    choose_pair, discount_label, discount_pct, format_price, normalize_price,
    price_candidates, price_pair, score_pair, source_bonus, to_float,
)
from .sizes import size_tokens, sorted_size_text, stock_priority, stock_state, stock_status
from .text import clean_text, end_date_text, few_words, word_count
from .urls import (
    is_blocked_url, is_campaign_url, is_http, is_listing_url, is_product_url, is_site_url,
    page_kinds, resolve_url, same_url_key, url_host, url_id, url_path,
)

__all__ = [n for n in dir() if not n.startswith("_")]
