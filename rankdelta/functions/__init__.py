"""Column expressions; everything here stays inside the JVM (no Python UDFs)."""

from rankdelta.functions.text import (  # noqa: F401
    clean_title, clean_title_plain, collapse_ws, first_non_blank, match_key,
    split_brand_product, strip_ws,
)
from rankdelta.functions.price import (  # noqa: F401
    price_amount, price_first_number, price_with_symbol,
)
from rankdelta.functions.status import (  # noqa: F401
    movement_status, snapshot_label, trend_class,
)
