"""Entry point for spark-submit; ``--help`` lists the jobs."""

import sys

from daytally.jobs import main

if __name__ == "__main__":
    main(sys.argv[1:])
