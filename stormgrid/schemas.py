"""Fixed schemas of sources and stored tables (DDL text)."""

# radar products: points, or warning polygons as rings
HAIL_POINTS = "id long, valid timestamp_ntz, sevprob int, maxsize double, lon double, lat double"
WARNINGS = "id long, valid timestamp_ntz, ring array<struct<x:double,y:double>>"
STORM_DETAILS = "EPISODE_ID long, EVENT_ID long, BEGIN_DATE_TIME timestamp_ntz, BEGIN_LAT double, BEGIN_LON double"

FEATURE = ("type string, properties map<string,string>, "
           "geometry struct<type:string,coordinates:string>")

ADDRESS_LONLAT = "longitude double, latitude double, number string, street string, city string, region string, postcode string"
OSM_NODE = "id long, lat double, lon double, tags map<string,string>"

PHONE = ("number string, type string, carrier string, score int, dnc boolean, reachable boolean, "
         "lastReportedDate string")
PROPERTY = (
    "_id string, "
    "address struct<street:string,streetNoUnit:string,formattedStreet:string,city:string,state:string,zip:string,"
    "zipPlus4:string,latitude:double,longitude:double,county:string>, "
    "ids struct<fipsCode:string>, "
    "assessment struct<totalAssessedValue:double,totalMarketValue:double>, "
    "building struct<yearBuilt:int,livingAreaSquareFeet:int>, "
    "general struct<vacant:boolean,standardizedLandUseCode:string,propertyTypeDetail:string>, "
    "intel struct<lastSoldDate:string,lastSoldPrice:double>, "
    f"owner struct<ownerOccupied:boolean,emails:array<string>,phoneNumbers:array<struct<{PHONE.replace(' string', ':string').replace(' int', ':int').replace(' boolean', ':boolean').replace(', ', ',')}>>>")
SEARCH_RESULT = (
    "externalId string, property struct<parcelId:string,sqFt:int,yearBuilt:int,assessedValue:double>, "
    "owners array<struct<name:string,phone:string,email:string,mailingAddress:string>>")

IMPORT_LOG = "file_path string, imported_at timestamp_ntz"
RUN_LOG = "ts timestamp_ntz, state string, step string, status string, note string"
TRACES = "address_id long, batch_job_id string, status string, result string, completed_at timestamp_ntz"
RUNS = ("run_id long, state string, output_path string, created_at timestamp_ntz, batch_job_id string, "
        "webhook_url string, submitted_at timestamp_ntz, api_base string, last_error string")
WEBHOOK_EVENTS = ("received_at timestamp_ntz, job_id string, status string, event_type string, payload string, "
                  "headers map<string,string>")
