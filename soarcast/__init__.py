"""soarcast: hourly gridded weather and live station events, analysed on Spark.

Main entry points: ``transform`` (raw grid -> observations), ``MARTS`` (the ten curated
marts), ``run_batch`` (zone and marts end to end), the live views in ``streaming`` and
``start_live`` to run them as Structured Streaming queries.
"""

__version__ = "0.1.0"

from .functions import transform  # noqa: E402
from .plans import MARTS, run_batch  # noqa: E402
from .session import build_session  # noqa: E402
from .streaming import start_live  # noqa: E402

__all__ = ["MARTS", "build_session", "run_batch", "start_live", "transform"]
