import contextlib
import io


def explain(df, mode: str = "formatted") -> str:
    """The physical plan text as printed by ``DataFrame.explain``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
