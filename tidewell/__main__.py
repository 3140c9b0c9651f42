from tidewell.cli import main

raise SystemExit(main())
