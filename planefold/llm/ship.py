"""The code of this package for Python workers that cannot import it themselves."""

from planefold.session import send_code as ready

__all__ = ["ready"]
