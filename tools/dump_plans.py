"""Write the formatted physical plans of the headline queries to PLANS.md (sf0.01, AQE off
so the plan shown is the static plan; AQE only coalesces partitions / adapts joins on top)."""

from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from creditspark.plans.registry import queries  # noqa: E402
from creditspark.session import get_session  # noqa: E402

NAMES = ["stage_ecl", "portfolio_kpis", "stage_ecl_stressed", "irb_by_stage",
         "basel_grade_band_join", "tape_reconciliation", "auc", "pk_check"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    out = ["# Physical plans of headline queries (`tools/dump_plans.py`, sf0.01)\n"]
    for name in NAMES:
        df = queries()[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        # keep the operator tree and the scan / exchange / join details; drop long projection lists
        keep = []
        for line in text.splitlines():
            if len(line) > 400:
                line = line[:400] + " …"
            keep.append(line)
        out.append(f"\n## {name}\n\n```\n" + "\n".join(keep) + "\n```\n")
    (ROOT / "PLANS.md").write_text("".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
