from clinrisk.plans.pipeline import main

main()
