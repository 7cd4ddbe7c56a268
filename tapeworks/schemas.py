"""Fixed schemas: raw frames as text fields, derived tables typed."""

LEVELS = "array<struct<price:string,size:string>>"
RAW_FRAME = (
    "event_type string, market string, asset_id string, timestamp string, hash string, "
    f"bids {LEVELS}, asks {LEVELS}, price string, size string, side string, fee_rate_bps string, transaction_hash string, "
    "mark string, slug string, note string, from_ts double, to_ts double, lost_s double, _corrupt string"
)
QUOTES = (
    "day string, ts_ms long, bar_ts long, market string, asset_id string, side tinyint, best_bid double, best_bid_sz double, "
    "best_ask double, best_ask_sz double, mid double, spread double, n_bids smallint, n_asks smallint, book_hash string, slug string, is_primary tinyint"
)
TRADES = (
    "day string, ts_ms long, bar_ts long, market string, asset_id string, side tinyint, taker_side string, price double, "
    "size double, fee_rate_bps int, tx_hash string, slug string, is_primary tinyint"
)
MARKS = "day string, from_ts double, to_ts double, lost_s double, slug string, note string, coin string, cycle string, bar_ts long"
BAR_TOKENS = (
    "market string, slug string, up_token string, down_token string, outcome_kind string, outcome_prices string, "
    "winner string, closed boolean, question string, end_date string"
)
