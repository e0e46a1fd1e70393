from catloss.functions.exprs import (
    clip_keep_null,
    ieee_div,
    parse_loss,
    rp_bucket,
    strip_ws,
    sum0,
    vendor_years,
)

__all__ = [
    "clip_keep_null",
    "ieee_div",
    "parse_loss",
    "rp_bucket",
    "strip_ws",
    "sum0",
    "vendor_years",
]
