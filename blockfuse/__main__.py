import sys

from blockfuse.plans.runner import main

sys.exit(main())
