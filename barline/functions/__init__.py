"""Column-level helpers: each returns a ``Column`` built from Spark built-ins."""

from barline.functions.timecols import (  # noqa: F401
    candle_time_exact, candle_time_seconds, date_of, hour_of, ms_to_date, ms_to_hour,
)
from barline.functions.series import (  # noqa: F401
    lag_col, pct_change, rolling_std, series_window, sma,
)
from barline.functions.signals import (  # noqa: F401
    band_position, macd_direction, rsi_signal, run_status_code,
)
