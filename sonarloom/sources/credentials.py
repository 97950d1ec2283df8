"""Credentials of a search or media host: from the environment, else from a netrc file. Nothing is stored or logged."""

from __future__ import annotations

import netrc
import os


def credentials(host: str, file: str | None = None, user: str = "SEARCH_USER", password: str = "SEARCH_PASSWORD") -> tuple[str, str] | None:
    """(name, password) for a host: the environment's if both are set, else the host's entry in a netrc file (default: the
    user's own), else None."""
    if os.environ.get(user) and os.environ.get(password):
        return os.environ[user], os.environ[password]
    try:
        entry = netrc.netrc(file).hosts.get(host)
    except FileNotFoundError:
        return None
    return (entry[0], entry[2] or "") if entry else None
