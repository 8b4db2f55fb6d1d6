from canopy.plans.cli import main

main()
