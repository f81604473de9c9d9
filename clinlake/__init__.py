"""clinlake: a Spark-native healthcare analytics warehouse.

Raw patient / encounter / clinical tables are turned into a staging layer,
an SCD2 patient dimension, encounter, readmission and clinical-event facts,
five reports, a declarative metric operator and a data-quality suite.
Every model is a function of a :class:`~clinlake.context.Context` that
returns a lazy DataFrame; Catalyst plans each sink action end to end.
"""

from clinlake.context import Context
from clinlake.session import build_session, ensure_checkpoint_dir

__all__ = ["Context", "build_session", "ensure_checkpoint_dir"]
