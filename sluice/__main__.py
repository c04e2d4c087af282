"""``python -m sluice ...`` runs the command-line jobs (see sluice/jobs.py)."""

import sys

from .jobs import main

sys.exit(main())
