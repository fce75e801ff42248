import sys

from tallyho.cli import main

sys.exit(main())
