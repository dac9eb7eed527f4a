from .codes import (  # noqa: F401
    flow_sign,
    flow_type,
    trade_sign,
    trade_type,
)
from .dates import (  # noqa: F401
    de_date,
    de_timestamp,
    moment,
    run_time,
    zeit_id,
)
from .rules import (  # noqa: F401
    check,
    first_error,
    isin_error,
    with_verdict,
)
from .text import canonical, clean, concat_text, cut, empty_to_null  # noqa: F401
