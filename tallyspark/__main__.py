from tallyspark.jobs import main

main()
