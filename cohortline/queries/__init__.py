"""All registered queries; importing the modules fills the registry."""

from cohortline.queries import derive, events, model, prepare, profile, stored  # noqa: F401
from cohortline.queries._registry import ORACLES, QUERIES  # noqa: F401
