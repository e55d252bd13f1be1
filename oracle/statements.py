"""One DuckDB statement per registered query."""

from .features import FEATURES
from .forecasts import FORECASTS
from .kpis import KPIS
from .models import MODELS
from .monitoring import MONITORING
from .streams import STREAMS

STATEMENTS = {**KPIS, **FEATURES, **MONITORING, **FORECASTS, **MODELS, **STREAMS}
