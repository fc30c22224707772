"""spark-submit launcher: ``spark-submit --py-files soarcast.zip submit.py <command> ...``."""

import sys

from soarcast.__main__ import main

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
