"""Identity resolution tables on PySpark.

Plain DataFrame-to-DataFrame operators plus a batch plan that keeps a set of
identity tables up to date from a web event stream.
"""

from idweave.config import Identifier, IdentityConfig, RunContext

__all__ = ["Identifier", "IdentityConfig", "RunContext"]
