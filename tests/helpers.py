"""What tests share."""

from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"


def canonical(frame):
    """Rows as sorted text, whatever the order of rows and columns."""

    def text(v):
        if v is None or v != v:
            return "null"
        if isinstance(v, float):
            return f"{v:.6f}"
        return f"{float(v):.6f}" if isinstance(v, int) and not isinstance(v, bool) else str(v)

    cols = sorted(frame.columns)
    return cols, sorted(tuple(text(v) for v in row) for row in frame[cols].astype(object).where(frame[cols].notna(), None).itertuples(index=False))
