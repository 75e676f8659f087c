from millrace.catalogue.categories import PATTERNS, category_frame
from millrace.catalogue.checks import COST_GROUP, FOREIGN_KEYS, PROFILE_META, STALE_COLUMNS, STRANDED_PAIRS
from millrace.catalogue.derivations import DERIVATIONS
from millrace.catalogue.references import SHARED
from millrace.catalogue.tables import SPECS
from millrace.catalogue import standard

__all__ = [
    "COST_GROUP",
    "DERIVATIONS",
    "FOREIGN_KEYS",
    "PATTERNS",
    "PROFILE_META",
    "SHARED",
    "SPECS",
    "STALE_COLUMNS",
    "STRANDED_PAIRS",
    "category_frame",
    "standard",
]
