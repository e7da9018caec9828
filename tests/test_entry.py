"""The entry module with and without the optional parts."""

import importlib.util
import sys
from pathlib import Path

import pytest

AT = Path(__file__).resolve().parents[1] / "__spark_entry__.py"


class Without:
    """Makes modules of these names, and those below them, look as if they were not there."""

    def __init__(self, *names):
        self.names = names

    def find_spec(self, name, path=None, target=None):
        if any(name == n or name.startswith(f"{n}.") for n in self.names):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return None


def entry(*names):
    held = {m: sys.modules.pop(m) for m in list(sys.modules) if any(m == n or m.startswith(f"{n}.") for n in ("satloom.llm", "corpus_pipeline"))}
    blocker = Without(*names)
    sys.meta_path.insert(0, blocker)
    try:
        spec = importlib.util.spec_from_file_location("entry_under_test", AT)
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        return module
    finally:
        sys.meta_path.remove(blocker)
        sys.modules.update(held)


@pytest.mark.parametrize("names", [("satloom.llm",), ("satloom.llm", "corpus_pipeline")])
def test_without_the_text_operators(names):
    module = entry(*names)
    known, sql = module.queries(), module.oracle_sql()
    assert "repeat_tables" in known and not any(n.startswith("op") and n[2].isdigit() for n in known) and "pipeline" not in known
    assert set(sql) <= set(known) and len(known) > 60


def test_what_fails_inside_an_optional_part_is_not_hidden():
    if importlib.util.find_spec("satloom.llm") is None:
        pytest.skip("the optional part is not there")
    with pytest.raises(ImportError):
        entry("satloom.llm.warc")
