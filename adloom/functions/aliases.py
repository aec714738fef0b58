"""Where each record field may sit in page JSON, in order of preference.

An alias is `<root>.<path>`. Roots: `ad` the ad object, `raw` the whole page JSON, and per section the
nested object `loc`, `prefs`, `user`, `pay` or `priv` (see `ROOTS`).
"""

# nested objects: first of these members of the ad object that is there
ROOTS = {
    "loc": ("location", "address", "locationInfo", "geoLocation"),
    "prefs": ("preferences", "roommatePreferences", "tenantPreferences"),
    "user": ("user", "poster", "postedByUser", "author", "owner", "contact"),
    "pay": ("payment", "paymentInfo", "orderInfo"),
    "priv": ("privacy", "settings", "visibilitySettings"),
}

PROPERTY = {
    "ad_id": ("ad.adId", "ad.id", "ad.listingId", "raw.query.adId"),
    "title": ("ad.title", "ad.adTitle", "ad.heading"),
    "listing_url": ("ad.listingUrl", "ad.url", "ad.canonicalUrl"),
    "property_type": ("ad.propertyType", "ad.type", "ad.accommodationType", "ad.roomType"),
    "accommodation_type": ("ad.accommodationType", "ad.accomodationType", "ad.roomType"),
    "building_name": ("ad.buildingName", "ad.buildingInfo.name"),
    "beds": ("ad.beds", "ad.bedrooms", "ad.noOfBedrooms", "ad.bedroom"),
    "baths": ("ad.baths", "ad.bathrooms", "ad.noOfBathrooms", "ad.bathroom"),
    "square_feet": ("ad.squareFeet", "ad.sqft", "ad.area", "ad.builtupArea"),
    "rent_amount": ("ad.rent", "ad.rentAmount", "ad.price", "ad.amount", "ad.monthlyRent"),
    "rent_currency": ("ad.currency", "ad.rentCurrency", "ad.priceCurrency"),
    "deposit": ("ad.deposit", "ad.securityDeposit", "ad.depositAmount"),
    "rent_frequency": ("ad.rentFrequency", "ad.frequency", "ad.billingCycle"),
    "utilities_included": ("ad.utilitiesIncluded", "ad.utilities", "ad.utilityIncluded"),
    "negotiable": ("ad.negotiable", "ad.isNegotiable", "ad.priceNegotiable"),
    "owner_or_agent": ("ad.postedBy", "ad.ownerType", "ad.role", "ad.sellerType"),
}
DESCRIPTION = {
    "full_description": ("ad.description", "ad.adDescription", "ad.details", "ad.aboutProperty"),
    "extra_notes": ("ad.extraNotes", "ad.notes", "ad.specialInstructions", "ad.additionalInfo"),
    "special_instructions": ("ad.specialInstructions", "ad.instructions", "ad.requirements"),
}
AVAILABILITY = {
    "available_from": ("ad.availableFrom", "ad.availFrom", "ad.moveInDate", "ad.availableDate", "ad.dateAvailable"),
    "available_to": ("ad.availableTo", "ad.availTo", "ad.moveOutDate"),
    "stay_type": ("ad.stayType", "ad.leaseTerm", "ad.leaseType", "ad.term"),
    "days_available": ("ad.daysAvailable", "ad.availabilityDays", "ad.daysOfWeek"),
    "short_term_allowed": ("ad.shortTermAllowed", "ad.shortTerm", "ad.allowShortTerm"),
    "long_term_allowed": ("ad.longTermAllowed", "ad.longTerm", "ad.allowLongTerm"),
}
LOCATION = {
    "full_address": ("ad.fullAddress", "ad.address", "loc.fullAddress", "loc.address"),
    "city": ("ad.city", "loc.city", "loc.cityName", "ad.cityName"),
    "state": ("ad.state", "loc.state", "loc.stateName", "ad.stateName"),
    "state_code": ("ad.stateCode", "loc.stateCode", "ad.stateShort"),
    "country": ("ad.country", "loc.country", "loc.countryName"),
    "country_code": ("ad.countryCode", "loc.countryCode"),
    "district": ("ad.district", "loc.district"),
    "locality": ("ad.locality", "loc.locality", "ad.neighborhood", "loc.neighborhood"),
    "metro_area": ("ad.metroArea", "loc.metroArea", "ad.metro", "ad.msaName"),
    "sub_locality": ("ad.subLocality", "loc.subLocality"),
    "zip_code": ("ad.zipCode", "ad.zipcode", "ad.postalCode", "ad.zip", "loc.zipCode", "loc.zip"),
    "display_address": ("ad.displayAddress", "loc.displayAddress"),
    "formatted_address": ("ad.formattedAddress", "loc.formattedAddress"),
    "latitude": ("ad.lat", "ad.latitude", "loc.lat", "loc.latitude", "ad.geoLat"),
    "longitude": ("ad.lng", "ad.lon", "ad.longitude", "loc.lng", "loc.longitude", "ad.geoLng"),
    "map_visibility": ("ad.mapVisibility", "ad.showMap", "loc.mapVisibility"),
    "neighborhoods": ("ad.neighborhoods", "loc.neighborhoods"),
    "nearby_neighborhoods": ("ad.nearbyNeighborhoods", "loc.nearbyNeighborhoods"),
    "nearby_landmarks": ("ad.nearbyLandmarks", "ad.landmarks", "loc.landmarks"),
}
PREFERENCES = {
    "preferred_gender": ("ad.preferredGender", "prefs.gender", "ad.gender", "ad.genderPreference"),
    "pets": ("ad.pets", "ad.petsAllowed", "prefs.pets"),
    "smoking": ("ad.smoking", "ad.smokingAllowed", "prefs.smoking"),
    "vegetarian": ("ad.vegetarian", "ad.vegOnly", "prefs.vegetarian"),
    "alcohol_allowed": ("ad.alcoholAllowed", "ad.alcohol", "prefs.alcohol"),
    "couples_welcome": ("ad.couplesWelcome", "ad.couples", "prefs.couples"),
    "age_range": ("ad.ageRange", "ad.preferredAge", "prefs.ageRange"),
    "occupation": ("ad.occupation", "ad.preferredOccupation", "prefs.occupation"),
    "languages": ("ad.languages", "ad.preferredLanguages", "prefs.languages"),
}
METADATA = {
    "active_date": ("ad.activeDate", "ad.postedDate", "ad.createdAt", "ad.publishedAt"),
    "expiry_date": ("ad.expiryDate", "ad.expDate", "ad.validTill"),
    "expiry_status": ("ad.expiryStatus", "ad.expired", "ad.isExpired"),
    "category": ("ad.category", "ad.adCategory", "raw.query.category"),
    "intent": ("ad.intent", "ad.adIntent"),
    "status": ("ad.status", "ad.adStatus", "ad.isActive"),
    "created_at": ("ad.createdAt", "ad.dateCreated", "ad.postedDate"),
    "updated_at": ("ad.updatedAt", "ad.lastModified", "ad.modifiedAt"),
    "timezone": ("ad.timezone", "ad.timeZone", "raw.locale"),
}
POSTER = {
    "display_name": ("user.displayName", "user.name", "user.fullName", "ad.postedByName", "ad.ownerName", "ad.contactName"),
    "email": ("user.email", "user.emailId", "ad.email", "ad.contactEmail"),
    "phone": ("user.phone", "user.mobile", "user.phoneNumber", "ad.phone", "ad.mobile", "ad.contactPhone"),
    "role": ("user.role", "user.userType", "ad.postedByRole"),
    "uid": ("user.uid", "user.userId", "user.id", "ad.userId", "ad.postedById"),
    "business": ("user.business", "user.businessName", "user.company"),
    "verification_status": ("user.verificationStatus", "user.verified", "user.isVerified", "ad.isVerified"),
    "profile_photo": ("user.profilePhoto", "user.photoUrl", "user.avatar", "user.picture"),
    "member_since": ("user.memberSince", "user.createdAt", "user.joinedAt"),
}
PAYMENT = {
    "payment_id": ("pay.paymentId", "ad.paymentId"),
    "order_id": ("pay.orderId", "ad.orderId"),
    "plan_id": ("pay.planId", "ad.planId"),
    "plan_name": ("pay.planName", "ad.planName"),
    "paid_amount": ("pay.paidAmount", "pay.amount", "ad.paidAmount"),
    "paid_at": ("pay.paidAt", "pay.paymentDate", "ad.paidAt"),
    "payment_method": ("pay.paymentMethod", "pay.method"),
    "promo_code": ("pay.promoCode", "pay.coupon", "ad.promoCode"),
    "duration_days": ("pay.durationDays", "pay.duration", "ad.durationDays"),
}
PRIVACY = {
    "hide_phone": ("priv.hidePhone", "ad.hidePhone", "ad.maskPhone"),
    "hide_email": ("priv.hideEmail", "ad.hideEmail", "ad.maskEmail"),
    "hide_address": ("priv.hideAddress", "ad.hideAddress"),
    "on_whatsapp": ("priv.whatsappactived", "ad.whatsappactived", "ad.whatsapp"),
    "map_visibility": ("priv.mapVisibility", "ad.mapVisibility", "ad.showMap"),
}
AD_ID = ("ad.adId", "ad.id", "ad.listingId", "raw.query.adId", "raw.query.id")

DEFAULTS = {"rent_currency": "USD", "intent": "rent"}
MASKED = ("email", "phone")
