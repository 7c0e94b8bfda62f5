"""A GET with retries, for the connectors."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request

#: Attempts, first pause in seconds (it doubles), and the answers worth another attempt.
ATTEMPTS, PAUSE, AGAIN = 3, 0.6, (429, 500, 502, 503, 504)


def get(url: str, params: dict | None = None, timeout: float = 45, attempts: int = ATTEMPTS) -> bytes:
    """The body of a page; raises what the last attempt raised."""
    whole = url + ("?" + urllib.parse.urlencode(params) if params else "")
    for k in range(attempts):
        try:
            with urllib.request.urlopen(urllib.request.Request(whole, headers={"User-Agent": "sievewright/1"}), timeout=timeout) as page:
                return page.read()
        except urllib.error.HTTPError as e:
            if e.code not in AGAIN or k + 1 == attempts:
                raise
        except urllib.error.URLError:
            if k + 1 == attempts:
                raise
        time.sleep(PAUSE * 2**k)
    raise AssertionError


def told(e: Exception) -> str:
    """An error as its row tells it: its type and the first 80 characters."""
    return f"{type(e).__name__}: {str(e)[:80]}"
