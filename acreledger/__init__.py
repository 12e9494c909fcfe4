"""Double-entry ledger analytics as PySpark DataFrame jobs.

Every public function takes DataFrames (usually a :class:`Ledger`) plus plain
parameters and returns a lazy DataFrame.  Nothing is collected to the driver and
nothing is written unless a sink function is called.
"""

from .sources.ledger import Ledger, load_ledger, write_ledger

__all__ = ["Ledger", "load_ledger", "write_ledger"]
