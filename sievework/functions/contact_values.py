"""Fixed values of the contact rules: word lists and patterns that decide whether an address or a number in prose belongs to a person.

Every value here is part of what a rule means and must equal the delivery standard's. Patterns are in Python's dialect.
"""

# Local parts and domains of addresses.
FILLER_WORDS = frozenset(
    """
    some your my mine this that these those the test fake dummy demo example sample placeholder fictitious ficticial
    whatever anything anyone anybody somebody someone person person1 person2 email mail mailid mail1 mail2 mail3 address
    address1 user username user1 account account1 name firstname lastname first last random noname noemail noaddress noone
    nobody anonymous anon blank empty null none new old password passwd login login4 id testmail testuser testemail
    samplemail sampleuser fakeemail fakeuser dummyemail dummyuser examplemail exampleuser randomemail randomuser somemail
    someuser someaddress yourmail yourname youraddress youraccount mymail myname mymailid myemailid myaddress myaccount
    useraccount mailaddress sometestemail test2.name2 name.name your.email youremail your.name
    """.split()
)

PLACEHOLDER_LOCALS = frozenset(
    """
    user username me my myself myemail email some someone somebody foo bar baz bla blah bla_bla abc xyz xample test tests
    aaa bbb ccc ddd xxx x example sample demo test1 test2 test3 admin root nobody none unknown guest john jane johndoe
    john.doe jane.doe someone.somewhere something anything user1 user2 user3 user4 account address user.name first.last
    firstlast your yourname your.email my.email my.email.address first last firstname lastname newuser newuser1 default
    testuser test.user dummy fake fakeuser sample.user sampleuser anyone anybody my.name myname local localuser local.user
    remote remoteuser remote.user client client1 client2 customer customer1 customer2 host server mail sender recipient you
    me1 me2 email1 email2 email3 email4 email5 addr emailaddress email.address hello world name test.user.name someone1 bob
    alice sam tom joe mary max jack jill fred bill craig giri mymail j.smith jdoe jd ab cd ef abcd xyz123 foo123 abc123
    user123 email123 hello123 myadmin joe2 userx xuser sample1 sample2 testuser1 testuser2 demo.user demo1 foo.bar
    john.smith first.last.name user.name1
    """.split()
)

PLACEHOLDER_DOMAINS = frozenset(
    """
    domain.com domain.org domain.net example.com example.org example.net example.info email.com myemail.com mycompany.com
    company.com client.com simple.com myapp.com mysystem.com somewhere.com body.com mydomain.com yourdomain.com
    somecompany.com yourcompany.com myaddress.com address.com domain.name domain.local sample.com test.com test.info
    test.net test.org testcompany.com fake.com fake.org your.com my.com something.com somethingelse.com myself.com
    mysite.com yoursite.com website.com ourwebsite.com mywebsite.com mysubdomain.com subdomain.com site.com someplace.com
    myplace.com yourplace.com some.net some.org mail.com mymail.com workmail.com work.com office.com dot.com ourdomain.com
    mydomain.org ourcompany.com myorganization.com myorg.com org.com corp.com business.com email.example.com xample.com
    adomain.com googleappsdomain.com testaddress.com comp.net shitmail.com gamil.com findme.com testwebsite.com
    olddomain.com name.com abcde.com samplewebsite.com abc.com xyz.com ab.com xy.com aa.com bb.com aa.aa bb.dd 123.com
    456.com g.com a.com b.com c.com foo.com bar.com baz.com qux.com blah.com server.com somedomain.com somedomain.org
    somedomain.net web.com nowhere.com customer.com user.com users.com localhost.com localhost.org localhost.net
    localhost.local contoso.com contoso.org contoso.net contoso.onmicrosoft.com fabrikam.com fabrikam.org fabrikam.net
    tailspintoys.com northwind.com adventureworks.com adventure-works.com
    """.split()
)

SERVICE_DOMAINS = frozenset(
    """
    openssh.com libssh.org jboss.org w3.org freenode.net jabber.org google.com googleapps.com googlecode.com
    googlegroups.com microsoft.com github.com bitbucket.org datatables.net mozilla.org apache.org sourceforge.net python.org
    ruby-lang.org php.net perl.org nodejs.org wordpress.org jquery.com bootstrap.com reactjs.org npmjs.com pypi.org
    maven.org gradle.org django.com rails.com thawte.com verisign.com digicert.com godaddy.com cpanel.net bluehost.com
    amazon.com apple.com adobe.com cpan.org facebook.com compaq.com caltech.edu bristol.ac.uk iki.fi gserviceaccount.com
    rhcloud.com appspot.gserviceaccount.com heroku.com herokussl.com googleusercontent.com gcp.gserviceaccount.com msu.ru
    pglaf.org joehewitt.com shinners.org wp.pl liveinternet.ru database.windows.com startb.com amazonaws.com googleapis.com
    appspot.com firebaseapp.com googlemail.com
    """.split()
)

PLACEHOLDER_FIRST = frozenset(
    """
    example sample test domain your my some fake dummy demo any our their the
    """.split()
)

INTERNAL_SUFFIXES = frozenset(
    """
    .internal .intranet .local .localhost .corp .corporate .dev .test .example .sample .demo .home .lan .private .vpc
    .cluster .k8s .svc .comput .azure .domain .mydomain
    """.split()
)

CODE_SUFFIXES = frozenset(
    """
    run data values value invoke invokeall string object class method function lambda this super field methodref bind
    service view collect create label node fieldlist filelist stringbuilder invokevirtual invokestatic array map set list
    dict collection iterator iter generator future promise task job worker pool queue stack tree graph buffer stream writer
    reader logger event signal slot fbx log xpi txt json plist css js xml py cs sh cfg conf ini pub lst ts scm template
    println tostring inspect equals trax adapter viewmodel finish route content split update dismiss toast invalidate
    callback emit rate nextlink pid host here dim sorteddate column rowspan toulong onreceive onawait nativead textsize
    prefwidth context binding navigateto onadloaded showtoast file length
    """.split()
)

SERVICE_LOCALS = frozenset(
    """
    git git2 gitlab deploy deployer ci jenkins build buildbot mockbuild sysmailer sysmail sysadmin noreply no-reply no.reply
    donotreply do-not-reply dontreply postmaster abuse security admin root info support help sales contact webmaster
    webadmin editor manager ops billing sysop mail mailer mailer-daemon hostmaster undeliverable errors error bounce
    maildaemon web www nobody daemon system host server hosting domain domainadmin post mailadmin spam report feedback
    alerts alert monitoring noc dba sre dev developer devs team group list lists announce announcements commits notify
    notifications notifier updates update digest digests news newsletter subscribe unsubscribe helpdesk ticket tickets csr
    care service services accounts account finance hr recruiting jobs careers press media pr marketing webteam it itdept
    itsupport tech techsupport api apis bot bots robot automated automation automailer autoreply autoresponder auto
    """.split()
)

CRYPTO_WORDS = frozenset(
    """
    hmac sha1 sha2 sha256 sha512 ripemd chacha poly1305 umac curve25519 gcm -cbc -ctr -etm ed25519 aes128 aes256 aes192
    rsa1024 rsa2048 rsa4096 ecdsa dh-group modp
    """.split()
)

PUBLIC_ADDRESSES = frozenset(
    """
    petsc-maint@mcs.anl.gov fortran@freebsd.org gcc@gcc.gnu.org mercurial@selenic.com iana@iana.org bug-autoconf@gnu.org
    bug-bash@gnu.org bug-cc-mode@gnu.org bug-gnu-gettext@gnu.org bug-wget@gnu.org emacs-orgmode@gnu.org help-make@gnu.org
    tramp-devel@gnu.org dm-devel@redhat.com cmake@www.cmake.org linux-unionfs@vger.kernel.org linux-usb@vger.kernel.org
    cypher@neo4j.org nbdev@netbeans.org redis@redis.io pgadmin4@pgadmin.org panel-launchers@cinnamon.org
    users@jna.dev.java.net users@tyrus.java.net users@rtems.org users@embedded-glassfish.java.net users@glassfish.java.net
    loom-dev@openjdk.java.net discuss@openjdk.org jsonassert-dev@skyscreamer.org gluster-users@gluster.org
    extensions-dev@chromium.org apps-dev@chromium.org ftpmaster@debian.org tomcat-owner@fedoraproject.org
    r-help@stat.math.ethz.ch cvs-ghc@haskell.org adelist@listes.univ-lyon1.fr donald.duck@duckburg.com
    vader@deathstar.empire.com mickey@disney.com peter.pan@wonder.com tonystark@avengers.com mickey.mouse@gmail.com
    bobdole@bobdole.com
    """.split()
)

EXPRESSION_WORDS = ("this", "it", "unless", "command", "or")
GENERATED_PREFIXES = ("mockbuild", "buildbot")
LONGEST_LOCAL = 28
LIST_NAME = (
    r'(?i)^(?:.*-)?(?:dev|devel|users?|lists?|announce|bugs?'
    r'|commits|patches|test|qa|doc|docs|hackers?)(?:-.*?)?$'
)

CRYPTO_LOCAL = (
    r'(?i)^(?:hmac|ssh|rsa|ecdsa|dsa|ed25519|curve|aes|chacha|poly1305|umac|gcm|cbc'
    r'|ctr|etm|md5|sha\d|ripemd|ecdh|poly|bcrypt|scrypt|argon|pbkdf|3des|blowfish'
    r'|twofish|seed|camellia|aria|sm2|sm3|sm4|md4|md6)[-_0-9a-z]*$'
)

FICTIONAL_LOCAL = (
    r'(?i)^(?:test|fake|sample|demo|dummy|guest|user\d*|customer\d*|account\d*|'
    r'one|two|three|four|five|alpha|beta|gamma|delta|nike\d?|blah_?|asdf+|zxcv+|'
    r'qwerty|asdfgh|abcd+|abcdefg|abcdefghi|abcdef|harry\.potter|jerry\.lane|'
    r'indiana\.jones|tom\.cruise|smith\d*|jones\d*|doe|redacted|phonenumber|'
    r'validname|somename|firstmail|secondmail|onlineshop|help_center|smiletest'
    r'|testguest|testcust\d*|xample\d*|smiley|hello|world|foo|bar|baz|qux|'
    r'lorem|ipsum|(?:abc|def|xyz)[a-z]?|sombody|someone|anobody|infobot\d*|name\d*)$'
)

PLACEHOLDER_DOMAIN_HEAD = (
    r'(?i)^(?:(?:my|your)(?:mail|email|name|domain|address|company|account|'
    r'password|username|user|tenant|app|site|service|server|host|test|sample|'
    r'example|phone|number|id|self|place|shop|data|admin|profile|credential|'
    r'website)\w*|whatever|parent)$'
)

TEMPLATE_LOCAL = (
    r'(?i)^(?:(?:my|your)(?:mail|email|name|domain|address|company|account|'
    r'password|username|user|tenant|app|site|service|server|host|test|sample|'
    r'example|phone|number|id|self|place|shop|data|admin|profile|credential|'
    r'login)\w*(?:\+\w+)?|(?:whatever|first|last)[\w.]*)$'
)

# What stands around an address or a number.
EMAIL_CUE = (
    r'(?i)(?:\bemail\b|\be-?mail\b|\bmail\b|contact|reach me|reach out|write to|'
    r'send to|send me|send a|mail to|mailing list|mail me|subscribe|thanks to|'
    r'suggested|submit|report it|file a|contact me|contact the|get in touch|'
    r'feel free to|feel free|ping me|let me know|my (?:email|e-?mail|address|email address)|'
    r'(?:email|e-?mail|mail|address)[:= ]|\bFrom:|\bTo:|\bCc:|\bBcc:|\bReturn-Path:|'
    r'Message-ID|E=|emailAddress=|\bCN=|\bC=|\bO=|Copyright|author|contribut|'
    r'get involved|someone like|address like|schema|for example|e\.g\.|such as|'
    r'sample|example|e\. g\.|comment by|note by|by [A-Z][a-z]+ [A-Z][a-z]+,|'
    r'made many changes|made a lot|altered by|added by|created by|maintained by|'
    r'register with|sign up|log ?in to|log ?into|test account|test login|test page|'
    r'sandbox|demo user|demo accoun|here is a test|test user|test credentials|'
    r'here is the|here are the|logon name|relay for|unable to relay|log into|'
    r'send the form|to the form|form to|send it to|send my|my password|mypass|'
    r'receive the message|message inside|send the form to|the form to|'
    r'you have at|you with|any questions|any questions you|talk about this|'
    r'communicate me|let me know|drop me|shoot me|message me|reach out|reach me via|'
    r'bereikbaar via|you can reach|can be reached|get me at|reach me at|contact me at|'
    r'you can mail|mail the author|author at|the author|project member|'
    r'valid email|invalid email|expected valid|valid emails|invalid emails|'
    r'dynamic values|sample data|test data|sample email|example email|'
    r'me at|email me|at my|my address|write to me|contact me|ping me|'
    r'best regards|\bregards,|\bbereik|\busername\b|\buser:|customer id|'
    r'customer email|\bbefore:|\bafter:|'
    r'formatted in the|will be:|looks like this|as follows|for example:|'
    r'like this:|in the format|same format|general way|sample output|'
    r'got the token|userprincipalname|accountenabled|lastsignindate|'
    r'identity exception|got an email from)'
)

EMAIL_CODE = (
    r'(?i)(?:%w\[|\.each\b|addresses\s*=|\bvalid_address|\bcat=\[|\bdat=|\bflg=|'
    r'IntentService|\bsmtptransport|\bSmtpClient|heroku\[|\[From\]|\[To\]|\[Subject\]|'
    r'5\.7\.1|->\s*\[|=\s*>|2147483647|\bINT_MAX|logon name|business=|payer_status|'
    r'sender-id|sender id|c2dm|gcm|fcm\b)'
)

RESOURCE_LABEL = (
    r'\s{0,2}(?:maximum\s+resident\s+set\s+size|'
    r'file\s+size|address\s+space|stack\s+size|'
    r'core\s+file\s+size|open\s+files|processes|'
    r'memory\s+lock|swaps|pipes|time|priority|'
    r'block\s+size|buffer\s+size|file\s+system\s+blocks|'
    r'socket\s+buffering|arg\s+max|stack\s+size)'
)

MAIL_HEADER_END = r'(?:From|To|Cc|Bcc|Return-Path|Message-ID|E|emailAddress)\s*[=:]?\s*$'
CODE_MARKS = '."\'/:=,@;(){}[]<>+*/&|!%$~^?#'
CODE_TOKEN = r'0[xXbB]|2\s*\*\*|\bbin\s*\(|\bhash|bytes|millis|nanoseconds|time_stamp|timestamp|epoch'
NOT_MOBILE = frozenset("800 833 844 855 866 877 888 900 901 902 903 904 905 906 907 908 909".split())

PHONE_OPERATOR = (
    r'=>|->|::|==|!=|<=|>=|\+\+|//|/\*|\*\*/'
)

PHONE_IDENTIFIER = (
    r'\b(?:println|print|echo|console|cout|return|import|function|'
    r'to_dict|astype|groupby|nextLong|nextInt|nextDouble|valueOf|'
    r'parseInt|toInt|sizeof)\b'
)

PHONE_EXAMPLE = (
    r'(?i)\bfor example\b|\be\.?\s?g\.?|\bexamples?\b|\bsamples?\b|'
    r'\bdummy\b|\bmock\b|\bplaceholder\b|\bhard ?code\b'
)

PHONE_RESOURCE = (
    r'(?i)\b(?:memory|bytes|size|capacity|heap|allocatable|'
    r'ephemeral-storage|memory_limit|physical size|event count|'
    r'uops|cycles|perf report|resident set|buffer pool|chunk size|'
    r'device|locality|bus_id)\b'
)

PHONE_ASSIGNED = r'=\s*$'
PHONE_JSON = r'"\s*:\s*$'
PHONE_CELL_BEFORE = r'\|\s*$'
PHONE_CELL_AFTER = r'^\s*\|'
PHONE_DECIMAL = r'(?<![0-9.,])\d+\.\d{2,}(?![0-9])'
PHONE_DATE = r'\b\d{4}-\d{2}-\d{2}\b'
PHONE_TIME = r'\b\d{1,2}:\d{2}:\d{2}\b'
PHONE_HEX = r'\b(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{6,}\b'
PHONE_NUMBER = r'(?<![0-9.])\d{4,}(?![0-9.])'
PHONE_EXPONENT = r'\de[+-]\d'
PHONE_SHELL = r'\$\S+\s+.*\d{3,}$|--\S+\s*$'

# Fixed value: configuration and diagnosis around a private address; Java reads it as well.
IP_CONFIGURATION = (
    r'(?:'
    r'\b(?:ipaddr|netmask|gateway|hwaddr|device|onboot|iface|address|network|'
    r'listen-address|dhcp-range|nameserver|interface|broadcast|subnetmask|server|'
    r'ip_address|domain_name_servers|routers)\b\s*[=:]'
    r'|\binet\b|\bbrd\s+\d|scope\s+global|\bvia\s+\d|\brouter\s+\d'
    r'|\bsrc:\s|\bdst:\s|src\s+port|dst\s+port'
    r'|client:|upstream:|request:|http/1\.\d|;push\s*"route'
    r'|\bping\b|traceroute|\bdig\b|nslookup|tcpdump|\+\s*short'
    r'|host_name_property|port_property|properties\.add|--to-destination|-j\s+dnat'
    r'|dnsmasq|wireguard|pfsense|opnsense|raspberry|\bvlan\b|\bfstab\b|\bnfs\b|\brdma\b'
    r'|ssh\s+[^@\s]+@|last login|no reply from|mount\s+-t|static\s+ip|af_inet'
    r'|\bresolving\b|connecting\s+to|looking\s+up\s+status|\bip\s+is\b|local\s+ip'
    r'|\bnetmask\b|\bbroadcast\b|\bgateway\b|\brouter(s)?\b'
    r'|\b(?:eth\d+w?\d*|wlan\d+|enp\w+)\b'
    r')'
)
