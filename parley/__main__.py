from parley.plans.build import main

main()
