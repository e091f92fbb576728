"""Sentences in each language, written for this repository, from which the first language model is trained."""

SEEDS: dict[str, str] = {
    "en": """Access denied, you are not allowed to see this page. Please try again later. The page you are looking for no longer exists. Congrats, that was well deserved. Your post text goes here. The meeting was moved to Friday because nobody could find a room. I think we should ask the customer before we change the price. There are three reasons why this will not work, and none of them is new. If you have any questions, please let me know by the end of the week. It took us months to understand what they really wanted. She said that the results were better than expected, but he did not believe her. Would you still choose the same tool today? We have been using it for two years and it has never failed. Most of the people who wrote the report have left the company since then. What surprised me was how quickly everything went back to normal. You do not need a large team for that. This is the best way to learn something about your own work. Our office keeps a list of open questions on the wall. My manager was not convinced at first. Thanks to everyone who helped with the release. Good morning, here is the summary of what happened last night. Nobody told me that it would be so hard to explain.""",
    "de": """Zugriff verweigert, Sie dürfen diese Seite nicht sehen. Bitte versuchen Sie es später noch einmal. Die gesuchte Seite gibt es nicht mehr. Danke für die Geduld und die schnelle Antwort. Die Besprechung wurde auf Freitag verschoben, weil niemand einen Raum finden konnte. Ich glaube, wir sollten den Kunden fragen, bevor wir den Preis ändern. Es gibt drei Gründe, warum das nicht funktionieren wird, und keiner davon ist neu. Wenn Sie Fragen haben, melden Sie sich bitte bis Ende der Woche. Wir haben Monate gebraucht, um zu verstehen, was sie wirklich wollten. Sie sagte, dass die Ergebnisse besser als erwartet waren, aber er glaubte ihr nicht. Würdest du heute noch dasselbe Werkzeug wählen? Wir benutzen es seit zwei Jahren und es hat nie versagt. Die meisten Leute, die den Bericht geschrieben haben, sind inzwischen nicht mehr da. Das Schwierigste ist nicht die Technik, sondern die Gewohnheit. Mich hat überrascht, wie schnell alles wieder normal wurde. Dafür braucht man keine große Mannschaft. Unser Büro führt eine Liste offener Fragen an der Wand. Meine Chefin war zuerst nicht überzeugt. Danke an alle, die geholfen haben. Seitdem sparen wir ungefähr zehn Stunden im Monat. Bitte schreibt mir einfach, dann schicke ich euch die Unterlagen.""",
    "nl": """Toegang geweigerd, u mag deze pagina niet bekijken. Probeer het later nog eens. De pagina die u zoekt bestaat niet meer. Met dank voor het geduld en het snelle antwoord. De vergadering werd naar vrijdag verplaatst omdat niemand een zaal kon vinden. Ik denk dat we het de klant moeten vragen voordat we de prijs veranderen. Er zijn drie redenen waarom dit niet gaat werken en geen daarvan is nieuw. Als u vragen heeft, laat het dan voor het einde van de week weten. Het heeft ons maanden gekost om te begrijpen wat ze echt wilden. Zij zei dat de resultaten beter waren dan verwacht, maar hij geloofde haar niet. Zou je vandaag nog steeds hetzelfde gereedschap kiezen? We gebruiken het al twee jaar en het heeft nooit gefaald. De meeste mensen die het verslag schreven zijn inmiddels vertrokken. Het moeilijkste is niet de techniek maar de gewoonte. Wat mij verraste was hoe snel alles weer normaal werd. Daar heb je geen grote ploeg voor nodig. Ons kantoor houdt een lijst met open vragen bij aan de muur. Mijn baas was eerst niet overtuigd. Bedankt aan iedereen die geholpen heeft. Sindsdien besparen we ongeveer tien uur per maand. Volgens mij is dat veel te duur, ook al denken zij er anders over. Weet iemand waarom niemand daar ooit iets over heeft opgeschreven?""",
    "fr": """Accès refusé, vous n'avez pas le droit de voir cette page. Veuillez réessayer plus tard. La page que vous cherchez n'existe plus. Merci pour votre aide et votre patience. La réunion a été reportée à vendredi parce que personne ne trouvait de salle. Je pense que nous devrions demander au client avant de changer le prix. Il y a trois raisons pour lesquelles cela ne marchera pas, et aucune n'est nouvelle. Si vous avez des questions, écrivez-moi avant la fin de la semaine. Il nous a fallu des mois pour comprendre ce qu'ils voulaient vraiment. Elle a dit que les résultats étaient meilleurs que prévu, mais il ne l'a pas crue. Choisiriez-vous encore le même outil aujourd'hui ? Nous l'utilisons depuis deux ans et il n'est jamais tombé en panne. La plupart des gens qui ont écrit le rapport sont partis depuis. Le plus difficile n'est pas la technique, c'est l'habitude. Ce qui m'a surpris, c'est la vitesse à laquelle tout est redevenu normal. On n'a pas besoin d'une grande équipe pour ça. Notre bureau garde une liste de questions ouvertes au mur. Ma responsable n'était pas convaincue au début. Merci à tous ceux qui ont aidé. Depuis, on gagne environ dix heures par mois. À mon avis, le budget reste trop cher, même si la direction pense le contraire. Pourquoi est-ce que personne ne l'a jamais documenté ?""",
    "es": """Acceso denegado, no tiene permiso para ver esta página. Vuelva a intentarlo más tarde. La página que busca ya no existe. Gracias por la paciencia y por responder tan pronto. La reunión se pasó al viernes porque nadie encontraba una sala. Creo que deberíamos preguntar al cliente antes de cambiar el precio. Hay tres razones por las que esto no va a funcionar, y ninguna es nueva. Si tienes alguna pregunta, escríbeme antes del final de la semana. Tardamos meses en entender lo que de verdad querían. Ella dijo que los resultados eran mejores de lo esperado, pero él no le creyó. ¿Elegirías hoy la misma herramienta? La usamos desde hace dos años y nunca ha fallado. La mayoría de la gente que escribió el informe ya se ha ido. Lo más difícil no es la técnica, sino la costumbre. Lo que me sorprendió fue lo rápido que todo volvió a la normalidad. Para eso no hace falta un equipo grande. Nuestra oficina tiene una lista de preguntas abiertas en la pared. Mi jefa no estaba convencida al principio. Gracias a todos los que ayudaron. Desde entonces ahorramos unas diez horas al mes. El comité cambió el plan sin avisar a nadie. ¿Alguien sabe por qué la dirección abandonó el sistema antiguo? Llevamos seis meses usando este programa y por fin es muy sencillo.""",
    "pt": """Acesso negado, você não tem permissão para ver esta página. Tente novamente mais tarde. A página que procura já não existe. Obrigado pela paciência e pela resposta tão rápida. A reunião foi adiada para sexta-feira porque ninguém encontrava uma sala. Acho que devíamos perguntar ao cliente antes de mudar o preço. Há três razões pelas quais isto não vai funcionar, e nenhuma é nova. Se tiver alguma dúvida, escreva-me até ao fim da semana. Demorámos meses a perceber o que eles realmente queriam. Ela disse que os resultados eram melhores do que o esperado, mas ele não acreditou. Você escolheria hoje a mesma ferramenta? Usamos isso há dois anos e nunca falhou. A maioria das pessoas que escreveram o relatório já saiu da empresa. O mais difícil não é a técnica, é o hábito. O que me surpreendeu foi a rapidez com que tudo voltou ao normal. Não é preciso uma equipa grande para isso. O nosso escritório tem uma lista de perguntas abertas na parede. A minha chefe não estava convencida no início. Obrigado a todos os que ajudaram. Desde então poupamos umas dez horas por mês. O fornecedor trocou o sistema antigo depois de muitas dúvidas. Alguém sabe por que o comitê não documentou isso? O plano ainda é caro demais, embora a direção não concorde.""",
    "it": """Accesso negato, non ha il permesso di vedere questa pagina. Riprovi più tardi. La pagina che cerca non esiste più. Grazie per la pazienza e per la risposta. La riunione è stata spostata a venerdì perché nessuno trovava una sala. Penso che dovremmo chiedere al cliente prima di cambiare il prezzo. Ci sono tre motivi per cui questo non funzionerà, e nessuno è nuovo. Se avete domande, scrivetemi entro la fine della settimana. Ci abbiamo messo mesi a capire che cosa volevano davvero. Lei ha detto che i risultati erano migliori del previsto, ma lui non le ha creduto. Sceglieresti ancora lo stesso strumento oggi? Lo usiamo da due anni e non si è mai guastato. La maggior parte delle persone che hanno scritto il rapporto se ne è andata. La parte più difficile non è la tecnica, è l'abitudine. Quello che mi ha sorpreso è quanto in fretta tutto sia tornato normale. Per questo non serve un gruppo grande. Il nostro ufficio tiene un elenco di domande aperte sul muro. La mia responsabile all'inizio non era convinta. Grazie a tutti quelli che hanno aiutato. Da allora risparmiamo circa dieci ore al mese. Secondo me il vecchio sistema resta troppo caro, anche se il comitato non è d'accordo. Qualcuno sa perché nessuno ha mai scritto nulla su questo? Abbiamo provato il programma per sei mesi e adesso funziona bene.""",
    "sv": """Åtkomst nekad, du får inte se den här sidan. Försök igen senare. Sidan du söker finns inte längre. Tack för tålamodet och det snabba svaret. Mötet flyttades till fredag eftersom ingen kunde hitta ett rum. Jag tycker att vi borde fråga kunden innan vi ändrar priset. Det finns tre skäl till att det här inte kommer att fungera, och inget av dem är nytt. Om du har frågor får du gärna höra av dig före veckans slut. Det tog oss månader att förstå vad de egentligen ville. Hon sa att resultaten var bättre än väntat, men han trodde henne inte. Skulle du fortfarande välja samma verktyg i dag? Vi har använt det i två år och det har aldrig gått sönder. De flesta som skrev rapporten har slutat sedan dess. Det svåra är inte tekniken utan vanan. Det som förvånade mig var hur snabbt allt blev normalt igen. Man behöver ingen stor grupp för det. Vårt kontor har en lista med öppna frågor på väggen. Min chef var inte övertygad i början. Tack till alla som hjälpte till. Sedan dess sparar vi ungefär tio timmar i månaden. Ledningen bytte ut det gamla systemet utan att fråga någon. Vet någon varför ingen skrev ner det här? Jag tycker fortfarande att planen är för dyr, även om styrgruppen inte håller med. Leverantören väntade länge men ändrade sig till slut.""",
    "pl": """Odmowa dostępu, nie masz uprawnień do tej strony. Spróbuj ponownie później. Strona, której szukasz, już nie istnieje. Dzięki za cierpliwość i szybką odpowiedź. Spotkanie przeniesiono na piątek, bo nikt nie mógł znaleźć sali. Myślę, że powinniśmy zapytać klienta, zanim zmienimy cenę. Są trzy powody, dla których to nie zadziała, i żaden nie jest nowy. Jeśli masz pytania, napisz do mnie przed końcem tygodnia. Miesiące zajęło nam zrozumienie, czego naprawdę chcieli. Powiedziała, że wyniki były lepsze niż oczekiwano, ale on jej nie uwierzył. Czy dziś nadal wybrałbyś to samo narzędzie? Używamy go od dwóch lat i nigdy nie zawiodło. Większość osób, które napisały raport, już odeszła z firmy. Najtrudniejsza nie jest technika, tylko przyzwyczajenie. Zaskoczyło mnie, jak szybko wszystko wróciło do normy. Nie potrzeba do tego dużego zespołu. Nasze biuro trzyma na ścianie listę otwartych pytań. Moja szefowa na początku nie była przekonana. Dziękuję wszystkim, którzy pomogli. Od tamtej pory oszczędzamy około dziesięciu godzin miesięcznie. Moim zdaniem stary system trzeba uprościć, choć zarząd uważa inaczej. Czy ktoś wie, dlaczego nikt nigdy tego nie opisał? Komitet wymienił plan szkoleń, żeby obniżyć koszty. Dostawca po długich wahaniach zmienił zdanie i wreszcie wszystko działa bez niespodzianek.""",
    "tr": """Erişim reddedildi, bu sayfayı görme izniniz yok. Lütfen daha sonra tekrar deneyin. Aradığınız sayfa artık yok. Sabrınız ve hızlı yanıtınız için teşekkürler. Toplantı cuma gününe alındı çünkü kimse bir oda bulamadı. Bence fiyatı değiştirmeden önce müşteriye sormalıyız. Bunun neden işe yaramayacağına dair üç sebep var ve hiçbiri yeni değil. Sorunuz olursa lütfen hafta sonuna kadar bana yazın. Gerçekten ne istediklerini anlamamız aylar sürdü. Sonuçların beklenenden iyi olduğunu söyledi ama o inanmadı. Bugün yine aynı aracı seçer miydin? İki yıldır kullanıyoruz ve hiç bozulmadı. Raporu yazan insanların çoğu o zamandan beri ayrıldı. En zor kısım teknik değil, alışkanlık. Beni şaşırtan, her şeyin ne kadar çabuk normale döndüğüydü. Bunun için büyük bir ekibe gerek yok. Ofisimiz duvarda açık soruların bir listesini tutuyor. Müdürüm başta ikna olmamıştı. Yardım eden herkese teşekkürler. O günden beri ayda yaklaşık on saat kazanıyoruz. Yönetim uzun bir tereddütten sonra eski sistemi değiştirdi. Bunu neden kimsenin yazmadığını bilen var mı? Kurul aynı fikirde değil ama eğitim planını sadeleştirmek gerekiyor. Tedarikçi kimseye haber vermeden onay sürecini değiştirdi.""",
    "ru": """Встречу перенесли на пятницу, потому что никто не смог найти комнату. Я думаю, что нам стоит спросить клиента, прежде чем менять цену. Есть три причины, по которым это не сработает, и ни одна из них не новая. Если у вас есть вопросы, напишите мне до конца недели. Нам понадобились месяцы, чтобы понять, чего они на самом деле хотели. Она сказала, что результаты лучше, чем ожидалось, но он ей не поверил. Выбрали бы вы сегодня тот же инструмент? Мы пользуемся им уже два года, и он ни разу не подвёл. Большинство людей, которые писали отчёт, с тех пор ушли. Самое трудное здесь не техника, а привычка. Меня удивило, как быстро всё вернулось в норму. Для этого не нужна большая команда. Спасибо всем, кто помог. С тех пор мы экономим около десяти часов в месяц. Кто-нибудь знает, почему это никогда не описывали? По-моему, старую систему пора упростить, хотя комиссия так не считает. Дирекция после долгих сомнений заменила план обучения.""",
    "uk": """Зустріч перенесли на п'ятницю, бо ніхто не зміг знайти кімнату. Я думаю, що нам варто запитати клієнта, перш ніж змінювати ціну. Є три причини, чому це не спрацює, і жодна з них не нова. Якщо у вас є запитання, напишіть мені до кінця тижня. Нам знадобилися місяці, щоб зрозуміти, чого вони насправді хотіли. Вона сказала, що результати кращі, ніж очікувалося, але він їй не повірив. Чи вибрали б ви сьогодні той самий інструмент? Ми користуємося ним уже два роки, і він жодного разу не підвів. Більшість людей, які писали звіт, відтоді пішли. Найважче тут не техніка, а звичка. Мене здивувало, як швидко все повернулося до норми. Для цього не потрібна велика команда. Дякую всім, хто допоміг. Відтоді ми заощаджуємо близько десяти годин на місяць. Чи хтось знає, чому цього ніколи не описували? На мою думку, стару систему час спростити, хоча комісія так не вважає. Група підтримки після довгих вагань замінила план навчання.""",
    "zh": """会议改到星期五，因为没有人能找到房间。我认为在改变价格之前应该先问客户。这件事行不通有三个原因，没有一个是新的。如果有问题，请在本周末之前告诉我。我们花了几个月才明白他们真正想要什么。她说结果比预期的好，但是他不相信。今天你还会选择同样的工具吗？我们已经用了两年，从来没有出过问题。写报告的人大多数已经离开了公司。最难的不是技术，而是习惯。让我惊讶的是一切恢复正常的速度。这不需要很大的团队。谢谢所有帮忙的人。从那以后，我们每个月大约节省十个小时。有人知道为什么没有人记录这件事吗？我个人觉得旧系统应该简化，不过管理层并不同意。供应商没有打招呼就更换了培训计划。""",
    "ja": """誰も部屋を見つけられなかったので、会議は金曜日に変更されました。価格を変える前にお客様に聞くべきだと思います。これがうまくいかない理由は三つありますが、どれも新しいものではありません。質問があれば、今週末までに知らせてください。彼らが本当に何を望んでいるのか理解するのに数か月かかりました。彼女は結果が予想より良かったと言いましたが、彼は信じませんでした。今日でも同じ道具を選びますか。二年間使っていますが、一度も壊れたことがありません。報告書を書いた人の多くはもう会社を辞めました。難しいのは技術ではなく習慣です。すべてがすぐに元に戻ったことに驚きました。そのために大きなチームは必要ありません。手伝ってくれた皆さん、ありがとうございます。それ以来、毎月およそ十時間を節約できています。なぜ誰もこれを記録しなかったのでしょうか。個人的には古い仕組みを見直すべきだと思いますが、経営陣は反対しています。""",
    "ko": """아무도 방을 찾지 못해서 회의가 금요일로 옮겨졌습니다. 가격을 바꾸기 전에 고객에게 물어봐야 한다고 생각합니다. 이것이 안 되는 이유는 세 가지가 있고 새로운 것은 없습니다. 질문이 있으면 이번 주말까지 알려 주세요. 그들이 정말로 무엇을 원하는지 이해하는 데 몇 달이 걸렸습니다. 가장 어려운 것은 기술이 아니라 습관입니다. 도와주신 모든 분께 감사드립니다. 그 이후로 매달 약 열 시간을 절약하고 있습니다.""",
    "ar": """تم نقل الاجتماع إلى يوم الجمعة لأن أحدا لم يجد غرفة. أعتقد أنه يجب أن نسأل العميل قبل تغيير السعر. هناك ثلاثة أسباب تجعل هذا لا يعمل، وليس أي منها جديدا. إذا كانت لديك أسئلة فاكتب لي قبل نهاية الأسبوع. استغرقنا شهورا لنفهم ما يريدونه حقا. أصعب شيء ليس التقنية بل العادة. شكرا لكل من ساعد. منذ ذلك الحين نوفر حوالي عشر ساعات في الشهر.""",
    "hi": """बैठक शुक्रवार को कर दी गई क्योंकि किसी को कमरा नहीं मिला। मुझे लगता है कि कीमत बदलने से पहले हमें ग्राहक से पूछना चाहिए। इसके काम न करने के तीन कारण हैं और उनमें से कोई नया नहीं है। यदि आपके कोई सवाल हैं तो सप्ताह के अंत तक मुझे बताएं। सबसे कठिन तकनीक नहीं बल्कि आदत है। मदद करने वाले सभी लोगों का धन्यवाद। तब से हम हर महीने लगभग दस घंटे बचाते हैं।""",
    "el": """Η συνάντηση μεταφέρθηκε στην Παρασκευή επειδή κανείς δεν βρήκε αίθουσα. Νομίζω ότι πρέπει να ρωτήσουμε τον πελάτη πριν αλλάξουμε την τιμή. Υπάρχουν τρεις λόγοι για τους οποίους αυτό δεν θα λειτουργήσει. Αν έχετε ερωτήσεις, γράψτε μου μέχρι το τέλος της εβδομάδας. Το πιο δύσκολο δεν είναι η τεχνική αλλά η συνήθεια. Ευχαριστώ όλους όσους βοήθησαν. Από τότε εξοικονομούμε περίπου δέκα ώρες τον μήνα.""",
    "cs": """Schůzka byla přesunuta na pátek, protože nikdo nemohl najít místnost. Myslím, že bychom se měli zeptat zákazníka, než změníme cenu. Existují tři důvody, proč to nebude fungovat, a žádný z nich není nový. Pokud máte otázky, napište mi do konce týdne. Trvalo nám měsíce, než jsme pochopili, co opravdu chtějí. Řekla, že výsledky jsou lepší, než se čekalo, ale on jí nevěřil. Nejtěžší není technika, ale zvyk. Děkuji všem, kteří pomohli. Od té doby ušetříme asi deset hodin měsíčně. Ví někdo, proč to nikdo nikdy nepopsal? Podle mě je třeba starý systém zjednodušit, i když vedení nesouhlasí.""",
    "fi": """Kokous siirrettiin perjantaille, koska kukaan ei löytänyt huonetta. Minusta meidän pitäisi kysyä asiakkaalta ennen kuin muutamme hintaa. On kolme syytä, miksi tämä ei toimi, eikä mikään niistä ole uusi. Jos sinulla on kysyttävää, kirjoita minulle viikon loppuun mennessä. Vaikeinta ei ole tekniikka vaan tottumus. Kiitos kaikille, jotka auttoivat. Siitä lähtien olemme säästäneet noin kymmenen tuntia kuukaudessa. Tietääkö kukaan, miksi tätä ei ole koskaan kirjattu?""",
    "da": """Mødet blev flyttet til fredag, fordi ingen kunne finde et lokale. Jeg synes, vi burde spørge kunden, før vi ændrer prisen. Der er tre grunde til, at det her ikke kommer til at virke, og ingen af dem er nye. Hvis du har spørgsmål, så skriv til mig inden ugens udgang. Det tog os måneder at forstå, hvad de egentlig ville. Det sværeste er ikke teknikken, men vanen. Tak til alle, der hjalp. Siden da sparer vi omkring ti timer om måneden. Er der nogen, der ved, hvorfor ingen nogensinde har skrevet det ned?""",
    "ro": """Ședința a fost mutată vineri pentru că nimeni nu a găsit o sală. Cred că ar trebui să întrebăm clientul înainte de a schimba prețul. Există trei motive pentru care acest lucru nu va funcționa și niciunul nu este nou. Dacă aveți întrebări, scrieți-mi până la sfârșitul săptămânii. Cel mai greu nu este tehnica, ci obiceiul. Mulțumesc tuturor celor care au ajutat. De atunci economisim aproximativ zece ore pe lună. Știe cineva de ce nimeni nu a descris acest lucru?""",
    "hu": """A megbeszélést péntekre tették át, mert senki sem talált szobát. Azt hiszem, meg kellene kérdeznünk az ügyfelet, mielőtt megváltoztatjuk az árat. Három oka van annak, hogy ez nem fog működni, és egyik sem új. Ha kérdése van, írjon nekem a hét végéig. A legnehezebb nem a technika, hanem a szokás. Köszönöm mindenkinek, aki segített. Azóta havonta körülbelül tíz órát takarítunk meg.""",
    "vi": """Cuộc họp được chuyển sang thứ sáu vì không ai tìm được phòng. Tôi nghĩ chúng ta nên hỏi khách hàng trước khi thay đổi giá. Có ba lý do khiến điều này không hiệu quả và không có lý do nào mới. Nếu bạn có câu hỏi, hãy viết cho tôi trước cuối tuần. Điều khó nhất không phải là kỹ thuật mà là thói quen. Cảm ơn tất cả những người đã giúp đỡ.""",
    "id": """Rapat dipindahkan ke hari Jumat karena tidak ada yang bisa menemukan ruangan. Saya pikir kita harus bertanya kepada pelanggan sebelum mengubah harga. Ada tiga alasan mengapa ini tidak akan berhasil dan tidak satu pun yang baru. Jika Anda memiliki pertanyaan, tulis kepada saya sebelum akhir pekan. Yang paling sulit bukan tekniknya melainkan kebiasaannya. Terima kasih kepada semua yang telah membantu. Sejak itu kami menghemat sekitar sepuluh jam per bulan.""",
}
