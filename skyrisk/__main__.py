import json
import sys

from skyrisk.cli import GateError, main

if __name__ == "__main__":
    try:
        print(json.dumps(main(), default=str))
    except GateError as exc:
        print(str(exc), file=sys.stderr)
        sys.exit(1)
