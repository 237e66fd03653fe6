import re
import pathlib


def test_nothing_else_imports_the_package():
    root = pathlib.Path(__file__).resolve().parents[2]
    for path in [*root.glob("cinelake/**/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert not re.search(r"cinelake\.llm|corpus_pipeline", path.read_text()), path
