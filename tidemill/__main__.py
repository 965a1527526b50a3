"""python -m tidemill --config FILE [--batch-id ID] [--fail-at STAGE] [--health PORT]: runs one batch."""

from __future__ import annotations

import argparse
import json
import sys

from tidemill import session
from tidemill.plans import events
from tidemill.plans.batch import Batch
from tidemill.plans.config import STAGES, Config, ConfigError
from tidemill.plans.runner import StageError


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemill")
    p.add_argument("--config", required=True)
    p.add_argument("--batch-id")
    p.add_argument("--fail-at", choices=STAGES)
    p.add_argument("--json-logs", action="store_true")
    a = p.parse_args(args)
    events.logging_to(sys.stderr, as_json=a.json_logs)
    try:
        config = Config.load(a.config)
    except (ConfigError, OSError) as e:
        print(f"bad configuration: {e}", file=sys.stderr)
        return 2
    spark = session.session()
    try:
        m = Batch(spark, config, a.batch_id).run(a.fail_at)
    except StageError as e:
        print(e, file=sys.stderr)
        return 1
    print(json.dumps({"batch": m["batch_id"], "status": m["status"], "rows": {s: sum(t["rows"] for t in x["tables"].values()) for s, x in m["stages"].items()}}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
