"""Query plans. Importing this package registers every named query."""

from cardspark.plans import questions  # noqa: F401
from cardspark.plans import warehouse_queries  # noqa: F401
from cardspark.plans import star  # noqa: F401
from cardspark.plans import scd_queries  # noqa: F401
from cardspark.plans import features  # noqa: F401
from cardspark.plans import metrics  # noqa: F401
from cardspark.plans import eda  # noqa: F401
from cardspark.plans import models  # noqa: F401
from cardspark.streaming import velocity  # noqa: F401
from cardspark.plans import load  # noqa: F401
