"""Configuration of a remote source, checked when it is made."""

from __future__ import annotations

from dataclasses import dataclass

MODES = ("api", "html", "hybrid")


@dataclass(frozen=True)
class SourceProfile:
    identifier: str
    mode: str = "hybrid"
    listing_url: str | None = None
    api_list_url: str | None = None
    api_detail_url_template: str | None = None
    document_url_template: str | None = None
    pause: float = 1.5

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"the mode is one of {', '.join(MODES)}")
        if self.pause < 0:
            raise ValueError("the pause between requests can't be negative")
        interface = {"api_list_url": self.api_list_url, "api_detail_url_template": self.api_detail_url_template, "document_url_template": self.document_url_template}
        needed = {"listing_url": self.listing_url} if self.mode == "html" else interface
        absent = [name for name, value in needed.items() if not value]
        if absent:
            raise ValueError(f"mode {self.mode} needs {', '.join(absent)}")
