"""``python -m loanlake <mode> --source ... --out ...`` runs a job mode (see ``plans.jobs``)."""

from loanlake.plans.jobs import main

raise SystemExit(main())
