import sys

from gridcube.plans.cli import main

sys.exit(main())
