"""Session helpers of the package, under the names that this subpackage uses."""

from collections.abc import Iterable

from parley.session import cut, ship

__all__ = ["cut", "free", "ship"]


def free(columns: Iterable[str], name: str) -> str:
    """``name``, or one made from it that none of the columns has; case does not tell names apart."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
