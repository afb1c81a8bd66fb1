import sys

from tidemark.plans.cli import main

sys.exit(1 if main() else 0)
