"""Launcher for spark-submit (which runs files, not modules); see ordermart.__main__."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermart.__main__ import main  # noqa: E402

if __name__ == "__main__":
    main()
