"""Print the query names registered by one catalog module."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from panelwright.plans import catalog  # noqa: E402,F401
from panelwright.plans.registry import REGISTRY  # noqa: E402

module = sys.argv[1]
known = sys.modules[f"panelwright.plans.{module}"]
print(" ".join(n for n in REGISTRY if getattr(getattr(known, n, None), "__module__", "").endswith(module)))
