"""lanewatch: entity-risk analytics as Spark DataFrame operators.

Dirty event feeds -> cleaned feeds -> one feature row per entity ->
robust baseline -> anomaly ensemble -> business rules and risk tiers ->
explanations and robustness studies.  Every stage is a DataFrame -> DataFrame
function; Catalyst plans the work, Arrow-backed Python runs only where no
built-in operator exists (isolation-forest trees, kNN blocks, autoencoder).
"""

from lanewatch.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
