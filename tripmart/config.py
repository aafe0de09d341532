"""Project settings with argument > environment > default precedence (V2).

``setting(name, default, value=...)``: an explicit argument wins, then an
environment variable, then the default. Schema names follow the model kind:
core models go to the target schema, everything else to the staging schema
(falling back to the target one).
"""

from __future__ import annotations

import os
from typing import Any

# Fixed values (project variables used by the data tests and staging models)
PAYMENT_TYPE_VALUES = [1, 2, 3, 4, 5, 6]
DEFAULT_DAYS_BACK = 30
TEST_RUN_LIMIT = 100


def setting(name: str, default: Any = None, value: Any = None, env: str | None = None,
            cast: type | None = None) -> Any:
    if value is not None:
        out = value
    else:
        out = os.environ.get(env or name.upper(), default)
    if cast is not None and out is not None:
        out = cast(out)
    return out


def schema_for(model_kind: str, target_env: str = "TRIPMART_TARGET_SCHEMA",
               staging_env: str = "TRIPMART_STAGING_SCHEMA") -> str:
    target = os.environ.get(target_env)
    if model_kind == "core":
        if target is None:
            raise KeyError(f"{target_env} must be set")
        return target
    out = os.environ.get(staging_env, target)
    if out is None:
        raise KeyError(f"{staging_env} or {target_env} must be set")
    return out
