"""Polite access to public sources: one origin, bounded retries, block detection. Transports are plain callables."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit

from millrace.functions.html import Tree, strings, within

#: Phrases of a challenge page, its form fields, and statuses that are worth another try.
CHALLENGES = ("verify you are human", "complete the captcha", "access denied", "unusual traffic")
CHALLENGE_FIELDS = ("g-recaptcha-response", "h-captcha-response")
TRANSIENT = (408, 500, 502, 503, 504)


class AccessBlocked(RuntimeError):
    """The source refuses access; nothing more is asked of it."""


class OutOfScope(RuntimeError):
    """A URL leads away from the origin that was agreed on."""


class TransportError(Exception):
    """No reply came."""


@dataclass
class Reply:
    status: int
    url: str
    body: bytes
    headers: dict[str, str] = field(default_factory=dict)

    @property
    def text(self) -> str:
        return self.body.decode("utf-8", "replace")

    def json(self):
        return json.loads(self.body)


Transport = Callable[..., Reply]


def origin(url: str) -> tuple[str, str]:
    parts = urlsplit(url)
    if parts.scheme.lower() != "https" or not parts.netloc:
        raise OutOfScope(f"not an https URL: {url}")
    return parts.scheme.lower(), parts.netloc.lower()


def is_blocked(reply: Reply) -> bool:
    """Refused, or a page that asks for a captcha; a page that only mentions one is none."""
    if reply.status in (401, 403):
        return True
    if reply.status != 200 or b"captcha" not in reply.body.lower():
        return False
    tree = Tree(reply.text)
    title = next((" ".join(strings(n)).lower() for n in tree.nodes if n.name == "title"), "")
    body = " ".join("".join(strings(tree.root)).lower().split())
    form = any(n.attrs.get("name") in CHALLENGE_FIELDS and within(n, ("form",)) for n in tree.nodes)
    return form or "captcha" in title or any(c in body for c in CHALLENGES)


def over_https(method: str, url: str, json_body: object = None, timeout: float = 60) -> Reply:
    """The transport of the standard library."""
    data = None if json_body is None else json.dumps(json_body).encode()
    asked = urllib.request.Request(url, data, {"content-type": "application/json"} if data else {}, method=method)
    try:
        with urllib.request.urlopen(asked, timeout=timeout) as got:
            return Reply(got.status, got.url, got.read(), {k.lower(): v for k, v in got.headers.items()})
    except urllib.error.HTTPError as e:
        return Reply(e.code, e.url or url, e.read(), {k.lower(): v for k, v in e.headers.items()})
    except OSError as e:
        raise TransportError(str(e)) from e


def _wait(reply: Reply, tried: int) -> float:
    try:
        return float(reply.headers["retry-after"])
    except (KeyError, ValueError):
        return 2.0**tried


def request(send: Transport, method: str, url: str, *, allowed: tuple[str, str] | None = None, json_body: object = None, attempts: int = 3, pause: float = 0.0, sleep: Callable[[float], None] = time.sleep, rate_first: bool = False) -> Reply:
    """A reply of the allowed origin. ``rate_first``: a rate limit is looked at before where the reply came from."""
    allowed = allowed or origin(url)
    if origin(url) != allowed:
        raise OutOfScope(f"{url} is not of the agreed origin")
    for tried in range(attempts):
        last = tried + 1 == attempts
        try:
            reply = send(method, url, json_body)
        except TransportError:
            if last:
                raise
            sleep(2.0**tried)
            continue
        if pause:
            sleep(pause)
        limited = reply.status == 429
        if not (rate_first and limited):
            if origin(reply.url) != allowed:
                raise OutOfScope(f"the reply came from {reply.url}, which is not of the agreed origin")
            if is_blocked(reply):
                raise AccessBlocked(f"{url} was refused with status {reply.status}")
        if limited:
            if last:
                raise AccessBlocked(f"{url} still limits the rate")
            sleep(_wait(reply, tried))
        elif reply.status in TRANSIENT and not last:
            sleep(2.0**tried)
        elif reply.status >= 400:
            raise RuntimeError(f"status {reply.status}: {url}")
        else:
            return reply
    raise ValueError("attempts must be positive")
