"""The settings file: a list of temporary storage places."""

from __future__ import annotations

import os
import re
import tomllib
from pathlib import Path

from .errors import TideError


def default_path() -> Path:
    folder = os.environ.get("TABLETIDE_CONFIG_DIR") or os.path.join(os.environ.get("XDG_CONFIG_HOME") or os.path.expanduser("~/.config"), "tabletide")
    return Path(folder) / "tabletide.toml"


class Config:
    """Values of a settings file; changes leave the file's other lines as they are."""

    def __init__(self, path: Path | None = None):
        self.path = path or default_path()
        self.text = self.path.read_text() if self.path.exists() else ""
        self.values = tomllib.loads(self.text)

    @property
    def temporary(self) -> list[str]:
        return list(self.values.get("temporary", []))

    def add_temporary(self, value: str) -> None:
        if value not in self.temporary:
            self._set([*self.temporary, value])

    def remove_temporary(self, value: str) -> None:
        self._set([x for x in self.temporary if x != value])

    def _set(self, values: list[str]) -> None:
        quoted = ", ".join('"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"' for v in values)
        line = f"temporary = [{quoted}]"
        pattern = re.compile(r"^temporary\s*=\s*\[(?:[^\]\"']|\"(?:[^\"\\]|\\.)*\"|'[^']*')*\]", re.M)
        self.text = pattern.sub(lambda _: line, self.text) if pattern.search(self.text) else f"{line}\n{self.text}"
        self.values = tomllib.loads(self.text)
        self.path.parent.mkdir(parents=True, exist_ok=True)
        self.path.write_text(self.text)


def find_temporary(scheme: str, *lists: list[str]) -> str:
    """The first place with a scheme; lists that come first count first."""
    for values in lists:
        for v in values:
            if v.startswith(scheme):
                return v
    raise TideError(f"need --temporary={scheme}...")
