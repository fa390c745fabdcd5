import pytest

pytest.importorskip("tabletide.llm")
